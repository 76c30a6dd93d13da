"""Phase boundaries: tables written to the shared folder named by ``spark.checkpoint.dir``.

A written table cuts the lineage, survives the loss of executors, is read column by column, and
gives the optimizer true sizes. Only a local session without the setting gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="lexmill-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/lexmill-{app}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables this application has written here; results that still read them become invalid."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of few splits; inputs with enough splits pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
