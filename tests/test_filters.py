import pytest
from pyspark.sql import functions as F

from lexmill.functions.columns import STRIP_CHARS, strip, uniform_key
from lexmill.operators import filters

EDGES = [
    "     ", "a    ", " abcde　", "\x1cab\x85", "‌abc‌", "😀😀😀😀", "😀😀😀😀😀", "", " abcd ", "abcde", "﻿abcd", None,
]


def test_strip_set_is_what_python_strips():
    assert set(STRIP_CHARS) == {chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not chr(c).strip()}


def test_strip_equals_python(spark):
    df = spark.createDataFrame([(s,) for s in EDGES], "s string")
    got = [r[0] for r in df.select(strip(F.col("s"))).collect()]
    assert got == [s if s is None else s.strip() for s in EDGES]


def test_csv_filter_keeps_raw_text(spark):
    df = spark.createDataFrame([(s,) for s in EDGES], "text string")
    got = [r[0] for r in filters.csv_text_filter(df).collect()]
    assert got == [s for s in EDGES if isinstance(s, str) and len(s) >= 5 and s.strip() != ""]


def test_line_filter_trims_first(spark):
    df = spark.createDataFrame([(s,) for s in EDGES], "text string")
    got = [r[0] for r in filters.text_line_filter(df).collect()]
    assert got == [s.strip() for s in EDGES if s is not None and len(s.strip()) >= 5]


def test_audit_counts_both_sides(spark):
    df = spark.createDataFrame([(s,) for s in EDGES], "text string")
    row = filters.filter_audit(df).first()
    assert (row["n_before"], row["n_after"]) == (len(EDGES), filters.csv_text_filter(df).count())


def test_drop_incomplete(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "i string, t string")
    assert filters.drop_incomplete(df, ["i", "t"]).count() == 1


@pytest.mark.parametrize("parts", [1, 7])
def test_uniform_key_does_not_depend_on_partitions(spark, parts):
    df = spark.range(50).repartition(parts).select(uniform_key(42, F.col("id")).alias("k"))
    import hashlib

    want = sorted(int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) for i in range(50))
    assert sorted(r[0] for r in df.collect()) == want


@pytest.mark.parametrize("lines", [False, True])
def test_counts_are_taken_while_the_rows_are_written(spark, tmp_path, lines):
    df = spark.createDataFrame([("  a  ",), ("abcdef",), (None,), ("     ",), (" abcde ",), ("abcd",)], "text string")
    kept, seen = filters.observed_filter(df.repartition(3), lines=lines)
    kept.write.parquet(str(tmp_path / "kept"))
    audit = filters.filter_audit(df, lines=lines).first()
    assert seen.get == {"n_before": 6, "n_after": audit["n_after"]}
    assert spark.read.parquet(str(tmp_path / "kept")).count() == audit["n_after"]
