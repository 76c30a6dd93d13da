"""Text, CSV, pair and vocabulary scans. Every scan gives ``row_ord``, the place of the row in its files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.columns import na_to_null
from lexmill.operators.filters import csv_text_filter, drop_incomplete, text_line_filter
from lexmill.operators.ordinal import file_ordinal
from lexmill.sources import quoted

#: Value of ``multi_line`` for large CSV files with quoted line breaks.
SPLITS = "splits"


def _with_place(scan: DataFrame, *columns: Column) -> DataFrame:
    return scan.select(
        *columns, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")
    )


def _decoded(text: Column, strict_utf8: bool) -> Column:
    """Text with bytes that are not UTF-8 replaced by U+FFFD, or an error in strict mode."""
    if not strict_utf8:
        return F.make_valid_utf8(text)
    return F.when(F.is_valid_utf8(text), text).otherwise(F.raise_error(F.lit("text is not valid UTF-8")))


def scan_lines(spark: SparkSession, path: str | list[str], strict_utf8: bool = False) -> DataFrame:
    """One row per line; the line break may be LF, CR or CR LF."""
    return _with_place(spark.read.text(path), _decoded(F.col("value"), strict_utf8).alias("text"))


def scan_csv(
    spark: SparkSession, path: str | list[str], columns: dict[str, str], multi_line: bool | str = True
) -> DataFrame:
    """The chosen columns (name in the file to name in the result) as text, missing cells as null.

    ``multi_line`` says what may hold a line break: True reads each file in one task, which suits any file; ``SPLITS`` reads
    large files with quoted line breaks in many tasks (see :mod:`lexmill.sources.quoted` for what it expects); False
    is for files whose cells hold no line break.
    """
    table = spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line is True, quote='"', escape='"')
    absent = [c for c in columns if c not in table.columns]
    if absent:
        raise ValueError(f"no column {absent} in {path}; columns are {table.columns}")
    if multi_line == SPLITS:
        rows = quoted.scan_quoted(spark, path, table.columns, columns)
        return rows.withColumns({name: na_to_null(F.make_valid_utf8(name)) for name in columns.values()})
    return _with_place(table, *[na_to_null(F.col(f"`{c}`")).alias(name) for c, name in columns.items()])


def _numbered(rows: DataFrame) -> DataFrame:
    return quoted.record_ordinal(rows) if "_no" in rows.columns else file_ordinal(rows)


def read_corpus(
    spark: SparkSession,
    path: str,
    target_column: str | None = None,
    strict_utf8: bool = False,
    multi_line: bool | str = True,
) -> DataFrame:
    """(row_ord, text) of a `.csv` or `.txt` path, filtered, numbered in file order."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension == ".csv":
        if not target_column:
            raise ValueError("a CSV file needs target_column")
        if spark.read.text(path).filter(F.length(F.trim("value")) > 0).isEmpty():
            raise ValueError(f"{path} is empty")
        if strict_utf8 and not spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty():
            raise ValueError(f"{path} is not valid UTF-8")
        rows = csv_text_filter(scan_csv(spark, path, {target_column: "text"}, multi_line))
    elif extension == ".txt":
        rows = text_line_filter(scan_lines(spark, path, strict_utf8))
    else:
        raise ValueError(f"{path}: only .csv and .txt can be read")
    return _numbered(rows).select("row_ord", "text")


def read_eval_lines(spark: SparkSession, path: str) -> DataFrame:
    """(row_ord, text) with every line as it is, empty ones included."""
    return file_ordinal(scan_lines(spark, path)).select("row_ord", "text")


def _head(spark: SparkSession, path: str, columns: dict[str, str], n: int, multi_line: bool) -> DataFrame:
    """First ``n`` rows in file order. Files are opened in order, twice as many each time, until the
    rows suffice, so a large folder is not scanned for its first rows."""
    files = sorted(spark.read.text(path).inputFiles())
    many = 1
    while True:
        scan = scan_csv(spark, files[:many], columns, multi_line)
        if many >= len(files) or scan.limit(n).count() >= n:
            break
        many *= 2
    order = ["_path", "_block", "_mid"]
    head = scan.withColumn("_mid", F.monotonically_increasing_id()).orderBy(*order).limit(n)
    return head.withColumn("row_ord", (F.row_number().over(W.orderBy(*order)) - 1).cast("bigint")).drop(*order)


def read_pairs(
    spark: SparkSession,
    path: str,
    source: str = "inputs",
    target: str = "targets",
    head: int | None = None,
    multi_line: bool | str = True,
) -> DataFrame:
    """(row_ord, inputs, targets): the complete rows, or those of the first ``head`` rows."""
    columns = {source: "inputs", target: "targets"}
    if head is None:
        rows = _numbered(scan_csv(spark, path, columns, multi_line))
    else:
        # The first rows are few, so whole files are opened for them.
        rows = _head(spark, path, columns, head, multi_line is not False)
    return drop_incomplete(rows.select("row_ord", "inputs", "targets"), ["inputs", "targets"])


def sibling_eval_path(path: str) -> str:
    """Evaluation path of a train path. Without `train` in it, the train data is its own evaluation set."""
    return path.replace("train", "test")


def read_pair_splits(spark: SparkSession, path: str, eval_path: str | None = None, **options) -> DataFrame:
    """Train and evaluation pairs in one table with a ``split`` column."""
    sides = {"train": path, "test": eval_path or sibling_eval_path(path)}
    train, test = (read_pairs(spark, p, **options).withColumn("split", F.lit(s)) for s, p in sides.items())
    return train.unionByName(test)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(token, id, freq) from a file of one token per line; the id is the line number from 0."""
    lines = file_ordinal(scan_lines(spark, path))
    return lines.select(F.col("text").alias("token"), F.col("row_ord").cast("int").alias("id"), F.lit(0).cast("bigint").alias("freq"))
