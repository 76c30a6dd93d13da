import random

import pytest
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.operators.ordinal import bucketed_rank, dense_ordinal, exclusive_bases, shuffled_rank, sorted_ordinal
from lexmill.operators.packing import chunk_tokens, pack_causal


def token_rows(seed, n, longest):
    rng = random.Random(seed)
    return [[rng.randint(5, 99) for _ in range(rng.choice([0, 1, rng.randint(0, longest)]))] for _ in range(n)]


def frame(spark, rows, parts):
    df = spark.createDataFrame(list(enumerate(rows)), "row_ord bigint, input_ids array<int>")
    return df.repartition(parts, F.rand(1))


def chunk_model(rows, size, window):
    out = []
    for w in range(0, len(rows), window):
        joined = [t for row in rows[w : w + window] for t in row]
        out += [((w // window), i // size, joined[i : i + size]) for i in range(0, len(joined) - size + 1, size)]
    return out


@pytest.mark.parametrize("parts", [1, 16])
@pytest.mark.parametrize(("n", "size", "window"), [(205, 8, 100), (60, 3, 7), (5, 64, 1000), (40, 1, 10)])
def test_chunks_match_model(spark, n, size, window, parts):
    rows = token_rows(n + size, n, 30)
    got = chunk_tokens(frame(spark, rows, parts), size, window).orderBy("chunk_id").collect()
    assert [(r["window_id"], r["chunk_no"], r["input_ids"]) for r in got] == chunk_model(rows, size, window)
    assert all(r["labels"] == r["input_ids"] for r in got)
    assert all(r["attention_mask"] == [1] * size and r["token_type_ids"] == [0] * size for r in got)


def test_chunks_carry_other_lists(spark):
    rows = token_rows(3, 30, 12)
    df = frame(spark, rows, 3).withColumn("token_type_ids", F.transform("input_ids", lambda x: x + 1000))
    got = chunk_tokens(df, 4, 10, columns=["input_ids", "token_type_ids"]).collect()
    assert got and all(r["token_type_ids"] == [t + 1000 for t in r["input_ids"]] for r in got)


def test_one_very_long_row(spark):
    rows = [[7], list(range(5, 20_005)), [8, 9]]
    got = chunk_tokens(frame(spark, rows, 2), 128).orderBy("chunk_id").collect()
    assert [r["input_ids"] for r in got] == [c for _, _, c in chunk_model(rows, 128, 1000)]


def test_chunking_shuffles_tokens_once(spark):
    df = chunk_tokens(materialize(frame(spark, token_rows(1, 50, 9), 2), "tokens"), 4)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("parts", [1, 16])
@pytest.mark.parametrize(("n", "size"), [(700, 16), (300, 1), (3, 64), (140, 500)])
def test_causal_packing_matches_model(spark, n, size, parts):
    rows = token_rows(n * size, n, 40)
    stream = [t for row in rows for t in [*row, 3]]
    want = [stream[i : i + size] for i in range(0, len(stream) - size + 1, size)]
    got = pack_causal(frame(spark, rows, parts), 3, size).orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in got] == list(range(len(want)))
    assert [r["input_ids"] for r in got] == want


@pytest.mark.parametrize("parts", [1, 9])
def test_ranks_are_dense(spark, parts):
    ids = random.Random(4).sample(range(100_000), 500)
    df = spark.createDataFrame([(i, i % 3) for i in ids], "id bigint, part int").repartition(parts)
    want = {i: k for k, i in enumerate(sorted(ids))}
    assert {r["id"]: r["row_ord"] for r in dense_ordinal(df, "id").collect()} == want
    assert {r["id"]: r["row_ord"] for r in sorted_ordinal(df, ["id"]).collect()} == want
    per_part = shuffled_rank(df, 7, "id", "rank", ["part"]).groupBy("part").agg(
        F.array_sort(F.collect_list("rank")).alias("ranks")
    )
    assert all(r["ranks"] == list(range(len(r["ranks"]))) for r in per_part.collect())


def test_sorted_ordinal_splits_a_key_prefix_that_holds_most_rows(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("conv"), F.col("id").alias("turn"))
    got = sorted_ordinal(df, ["conv", "turn"]).orderBy("row_ord").collect()
    assert [(r["conv"], r["turn"]) for r in got] == sorted((r["conv"], r["turn"]) for r in got)
    assert [r["row_ord"] for r in got] == list(range(900))


def test_bases_over_many_buckets(spark):
    totals = [(b, (b * 7) % 5) for b in range(0, 90, 2)]
    df = spark.createDataFrame(totals, "b bigint, n bigint").repartition(6)
    got = {r["b"]: r["base"] for r in exclusive_bases(df, "b", "n").collect()}
    assert got == {b: sum(n for c, n in totals if c < b) for b, _ in totals}
    assert bucketed_rank(df, F.col("b"), ["b"], "rank").agg(F.max("rank")).first()[0] == len(totals) - 1


def test_bases_of_parts(spark):
    totals = [(p, b, 1 + (b * p) % 4) for p in (0, 1, 5) for b in range(40)]
    df = spark.createDataFrame(totals, "p int, b bigint, n bigint").repartition(6)
    got = {(r["p"], r["b"]): r["base"] for r in exclusive_bases(df, "b", "n", ["p"]).collect()}
    assert got == {(p, b): sum(n for q, c, n in totals if q == p and c < b) for p, b, _ in totals}


def test_scattered_ids_meet_in_few_ranges(spark, monkeypatch):
    """Hashed ids put every row into a bucket of its own; what one task adds up is still one row a range."""
    from lexmill.operators import ordinal

    met = []
    keep = ordinal.materialize
    monkeypatch.setattr(ordinal, "materialize", lambda df, tag: met.append(keep(df, tag)) or met[-1])
    df = spark.range(20_000).select(F.xxhash64("id").alias("id"))
    got = [r["row_ord"] for r in dense_ordinal(df, "id").orderBy("id").collect()]
    assert got == list(range(20_000))
    (totals,) = met
    assert totals.count() > 19_000
    assert totals.select("_range").distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
