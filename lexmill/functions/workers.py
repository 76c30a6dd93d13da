"""What Python workers need from a local session, and what they give back."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
from pyspark.sql import SparkSession


def reach_package(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package whatever their working folder is."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def give_back() -> None:
    """Return freed memory to the system: workers live on after a stage, and the next one adds to what they keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)
