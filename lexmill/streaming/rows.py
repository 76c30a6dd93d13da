"""The steps that look at one row at a time work on a stream as they are; this chains them.

Packing, splitting and batching need a finite, ordered input and have no streaming form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lexmill.operators.encode import encode_fixed
from lexmill.operators.filters import text_line_filter


def encode_lines(lines: DataFrame, vocab: DataFrame, length: int = 512) -> DataFrame:
    """Stream of text lines to fixed-length model inputs: trim, filter, encode, cut, pad."""
    return encode_fixed(text_line_filter(lines), vocab, length)


def write_rows(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available to Parquet files and stop; with the same checkpoint a restart goes on where the last
    call ended."""
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
