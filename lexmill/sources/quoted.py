"""Quoted CSV files read by many tasks, though a quoted cell may hold line breaks anywhere.

A line begins a record if the quotes before it in its file are even in number. Quotes are first counted per split (one number a
split moves), and added up over the splits of a file. Each split is then read again by one task, which knows what it begins inside
of and puts its lines together to records. Only records that reach over the border of two splits, one a split at most, are put
together by a shuffle. Cells are cut out of a record by the built-in CSV parser.

Doubled quotes inside a cell are two quotes, so they change nothing, and line breaks inside a cell stay as they are (the
whole-file parser makes LF of CR LF in files whose records end with CR LF). What the method cannot read as a whole-file parser does are
files that separate records by a carriage return alone, and quotes in the midst of cells that are not quoted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lexmill.functions.scratch import materialize
from lexmill.functions.workers import reach_package
from lexmill.operators.ordinal import sorted_ordinal

#: Bytes of text that a task hands on together.
_BATCH_CHARS = 1 << 20
#: Splits that begin within a quoted cell; their list is broadcast.
MAX_OPEN_SPLITS = 1 << 18
_FRAGMENTS = "_path string, _block bigint, _no bigint, _text string, _whole boolean"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")]
    return spark.read.text(path, lineSep="\n").select(*place, F.col("value").alias("line"))


def _open_splits(lines: DataFrame) -> DataFrame:
    """(_path, _block, _inside) of every split; ``_inside`` says that it begins within a quoted cell."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("_path", "_block").agg(F.sum(quotes).alias("_quotes"))
    before = F.sum("_quotes").over(W.partitionBy("_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    return counted.select("_path", "_block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("_inside"))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole splits, in order, to records.

    Records are numbered from 1 in their split; number 0 is what belongs to a record of an earlier one. The last record
    of a split that ends inside a cell, and number 0, are not whole.
    """
    out: list[tuple] = []
    size, split, number, inside, held = 0, None, 0, False, []

    def close(whole: bool) -> None:
        if held:
            out.append((*split, number, "\n".join(held), whole))
            held.clear()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("_path", "_block", "_inside", "line")]
        for path, block, starts_inside, line in zip(*columns):
            if (path, block) != split:
                close(number > 0 and not inside)
                split, number, inside = (path, block), 0, starts_inside
            if not inside:
                number += 1
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                close(number > 0)
            size += len(line)
            if size >= _BATCH_CHARS:
                yield _batch_of(out)
                out, size = [], 0
    close(number > 0 and not inside)
    if out:
        yield _batch_of(out)


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["_path", "_block", "_no", "_text", "_whole"])


def _records(lines: DataFrame) -> DataFrame:
    """(_path, _block, _no, _text) of every record; ``_block`` and ``_no`` tell where it begins."""
    reach_package(lines.sparkSession)
    inside = materialize(_open_splits(lines).filter("_inside"), "open_splits")
    n = inside.count()
    if n > MAX_OPEN_SPLITS:
        raise ValueError(f"{n} splits begin within a quoted cell, more than {MAX_OPEN_SPLITS}; read fewer files at a time")
    # Broadcast: the lines of a split have to stay together and in order.
    known = lines.join(F.broadcast(inside), ["_path", "_block"], "left").withColumn("_inside", F.coalesce("_inside", F.lit(False)))
    parts = materialize(known.select("_path", "_block", "_inside", "line").mapInArrow(_assemble, _FRAGMENTS), "csv_records")
    whole = parts.filter("_whole").drop("_whole")
    # A fragment belongs to the last record that begins at or before it: at most two fragments a split.
    order = W.partitionBy("_path").orderBy("_block", "_no")
    begins = F.when(F.col("_no") > 0, F.struct("_block", "_no"))
    owned = parts.filter("not _whole").withColumn("_owner", F.last(begins, ignorenulls=True).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_no", "_text")))["_text"]
    joined = owned.groupBy("_path", "_owner").agg(F.array_join(pieces, "\n").alias("_text"))
    return whole.unionByName(joined.select("_path", "_owner._block", "_owner._no", "_text"))


def scan_quoted(spark: SparkSession, path: str | list[str], names: list[str], columns: dict[str, str]) -> DataFrame:
    """The chosen columns (name in the file to name in the result) as text, with the place of each record
    (``_path, _block, _no``). ``names`` are all columns of the file, in order."""
    records = _records(_lines(spark, path)).withColumn("_text", F.regexp_replace("_text", "\r$", "")).filter("_text <> ''")
    heads = records.groupBy("_path").agg(F.min(F.struct("_block", "_no")).alias("_head")).select("_path", "_head._block", "_head._no")
    rows = records.join(heads, ["_path", "_block", "_no"], "left_anti")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    cells = F.from_csv("_text", F.lit(schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), {"quote": '"', "escape": '"', "multiLine": "true"})
    chosen = [F.col("_cells")[f"c{names.index(c)}"].alias(name) for c, name in columns.items()]
    return rows.withColumn("_cells", cells).select(*chosen, "_path", "_block", "_no")


def record_ordinal(rows: DataFrame, out: str = "row_ord") -> DataFrame:
    """Number the records of :func:`scan_quoted` (possibly filtered) in file order. They are written; only their places are sorted."""
    place = ["_path", "_block", "_no"]
    rows = materialize(rows, "csv_rows")
    return rows.join(sorted_ordinal(rows.select(*place), place, out), place).drop(*place)
