"""Row filters and the audit of what they keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexmill.functions.columns import strip

MIN_CHARS = 5


def keeps_csv_text(text: Column) -> Column:
    """Present, at least five code points *before* trimming, and not all whitespace."""
    return text.isNotNull() & (F.length(text) >= MIN_CHARS) & (strip(text) != "")


def csv_text_filter(df: DataFrame, column: str = "text") -> DataFrame:
    """Keep usable cells as they are (the value is not trimmed)."""
    return df.filter(keeps_csv_text(F.col(column)))


def text_line_filter(df: DataFrame, column: str = "text") -> DataFrame:
    """Trim, then keep lines of at least five code points."""
    return df.withColumn(column, strip(F.col(column))).filter(F.length(column) >= MIN_CHARS)


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop("any", subset=columns)


def _kept(column: str, lines: bool) -> Column:
    return F.length(strip(F.col(column))) >= MIN_CHARS if lines else keeps_csv_text(F.col(column))


def observed_filter(df: DataFrame, column: str = "text", lines: bool = False) -> tuple[DataFrame, Observation]:
    """The CSV text filter, or with ``lines`` the text line filter, counted by whatever job runs the result first.

    After that job ``Observation.get`` has ``n_before`` and ``n_after``; no second scan is made. (Rows are counted where they
    are read, so a plan that reads the result twice, or stops before its end, counts accordingly.)
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_before"), F.count_if(_kept(column, lines)).alias("n_after"))
    return (text_line_filter if lines else csv_text_filter)(counted, column), seen


def filter_audit(df: DataFrame, column: str = "text", lines: bool = False) -> DataFrame:
    """Rows before and after the CSV text filter, or with ``lines`` the text line filter, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(_kept(column, lines)).alias("n_after"))
