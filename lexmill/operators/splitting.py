"""Exact seeded train/test split, its size report, and the overlap audit of two sides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.columns import hex_prefix, md5_key

PREFIX_DIGITS = 4


def split_sizes_for(n: int, train_size: float, test_size: float) -> tuple[int, int]:
    """Row counts (train, test): test is rounded up, train down; rows left over are dropped."""
    if not (0 < train_size <= 1 and 0 < test_size <= 1 and train_size + test_size <= 1):
        raise ValueError(f"train_size={train_size} and test_size={test_size} must be fractions that sum to at most 1")
    n_test, n_train = math.ceil(test_size * n), math.floor(train_size * n)
    if n_train + n_test > n:
        raise ValueError(f"{n_train} train and {n_test} test rows asked for, {n} present")
    if n_train == 0:
        raise ValueError(f"{n} rows leave an empty train side")
    return n_train, n_test


def split_exact(
    df: DataFrame, train_size: float = 0.9, test_size: float = 0.1, seed: int = 42, id_col: str = "chunk_id"
) -> DataFrame:
    """Add ``split``: the rows with the smallest md5 keys are `test`, the next are `train`.

    Ranks are not needed, only the keys where the two sides end. A count per key prefix finds the
    prefix that holds each end, and only that prefix is sorted. Assigning the side is then a plain
    comparison: the rows themselves are never shuffled. ``df`` should be a written table.
    """
    keyed = df.select(md5_key(seed, F.col(id_col)).alias("key"), F.col(id_col).alias("id"))
    keyed = keyed.withColumn("prefix", hex_prefix(F.col("key"), PREFIX_DIGITS))
    # At most 16^PREFIX_DIGITS rows.
    sizes = keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    upto = sizes.withColumn("upto", F.sum("n").over(W.orderBy("prefix").rowsBetween(W.unboundedPreceding, 0)))
    n_train, n_test = split_sizes_for(df.count(), train_size, test_size)
    ranks = [n_test, n_test + n_train]
    holding = [(F.col("upto") >= r) & (F.col("upto") - F.col("n") < r) for r in ranks]
    ends = upto.filter(holding[0] | holding[1]).collect()  # one or two rows

    wanted = []
    for r in ranks:
        row = next(e for e in ends if e["upto"] - e["n"] < r <= e["upto"])
        wanted.append((row["prefix"], r - (row["upto"] - row["n"])))
    place = F.row_number().over(W.partitionBy("prefix").orderBy("key", "id"))
    candidates = keyed.filter(F.col("prefix").isin(*{p for p, _ in wanted})).withColumn("place", place)
    hit = [(F.col("prefix") == p) & (F.col("place") == k) for p, k in wanted]
    found = {(r["prefix"], r["place"]): (r["key"], r["id"]) for r in candidates.filter(hit[0] | hit[1]).collect()}

    rank_key = F.struct(md5_key(seed, F.col(id_col)).alias("key"), F.col(id_col).alias("id"))
    id_type = df.schema[id_col].dataType

    def end(i: int):
        key, value = found[wanted[i]]
        return F.struct(F.lit(key).alias("key"), F.lit(value).cast(id_type).alias("id"))

    side = F.when(rank_key <= end(0), F.lit("test")).when(rank_key <= end(1), F.lit("train"))
    return df.withColumn("split", side).filter(F.col("split").isNotNull())


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def text_digest(text: str = "text") -> Column:
    return F.sha2(F.col(text), 256)


def train_eval_overlap(df: DataFrame, digest: str = "digest") -> DataFrame:
    """Evaluation rows whose text also occurs in train: counts and ratio.

    ``df`` has ``split`` and the :func:`text_digest` of each row. Both sides are reduced to distinct
    texts with counts in one grouping, so any number of copies of one text is one row, and the texts
    themselves are not moved.
    """
    sums = df.groupBy(digest).agg(
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.count_if(F.col("split") == "train").alias("n_train"),
    )
    n_eval = F.coalesce(F.sum("n_test"), F.lit(0))
    n_overlap = F.coalesce(F.sum(F.when(F.col("n_train") > 0, F.col("n_test"))), F.lit(0))
    return sums.agg(n_eval.alias("n_eval"), n_overlap.alias("n_overlap")).withColumn(
        "ratio", F.when(F.col("n_eval") > 0, F.col("n_overlap") / F.col("n_eval"))
    )
