import pytest

import __spark_entry__ as contract
from lexmill.plans import oracle
from lexmill.plans.queries import QUERIES
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = ["csv_text_filter", "pair_head_dropna", "chat_format_full", "encode", "chunk_tokens", "train_eval_overlap", "masked_score"]


def test_every_query_has_its_sql():
    assert QUERIES.keys() == oracle.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["perplexity"] > 1


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    state, note = compare(spark, connect(SF), name, SF, contract.oracle_sql()[name])
    assert state == "ok", note
