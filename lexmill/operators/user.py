"""User functions on Arrow data, for what column expressions cannot say.

Spark partitions and shuffles the rows; the function sees one bounded table at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.columns import idiv
from lexmill.operators.packing import WINDOW_ROWS


def map_batches(rows: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to Arrow batches as they come; it may not depend on where a batch begins."""

    def run(batches):
        for batch in batches:
            yield fn(batch)

    return rows.mapInArrow(run, schema)


def map_windows(
    rows: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Apply ``fn`` to each window of ``window_rows`` consecutive rows, in order of a dense ``row_ord``.

    The result may have any number of rows.
    """

    def run(window: pa.Table) -> pa.Table:
        return fn(window.drop_columns(["_window"]).sort_by("row_ord"))

    windows = rows.withColumn("_window", idiv(F.col("row_ord"), window_rows))
    return windows.groupBy("_window").applyInArrow(run, schema)


def collate_batches(
    batches: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str, keys: list[str] | None = None
) -> DataFrame:
    """Apply ``fn`` to the rows of each batch, in order of ``pos_in_batch``."""

    def run(batch: pa.Table) -> pa.Table:
        return fn(batch.sort_by("pos_in_batch"))

    return batches.groupBy(*(keys or ["batch_id"])).applyInArrow(run, schema)
