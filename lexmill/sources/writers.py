"""Model folders, run logs and sharded batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.ngram import CausalModel, MaskedModel, TrigramModel

Model = CausalModel | MaskedModel | TrigramModel
MODELS = {"causal": CausalModel, "masked": MaskedModel, "trigram": TrigramModel}
TABLES = {
    "causal": ("bigrams", "contexts"),
    "masked": ("both", "sides", "left", "right", "unigrams"),
    "trigram": ("trigrams", "wide", "pairs", "narrow", "tokens", "discounts"),
}
LOG_SCHEMA = "run_id string, kind string, epoch int, name string, value double, text string"
PARAMS_SCHEMA = "kind string, vocab_size int, k double, weights array<double>"
SAVES_SCHEMA = "no bigint, epoch int, version string"


def save_model(model: Model, vocab: DataFrame, path: str, epoch: int | None = None) -> None:
    """Write the count tables, the parameters and the vocabulary; a later save takes the place of an earlier one.

    Every save is a folder of its own under ``versions``. The row in ``saves`` that names it is written last: until then, and if
    anything fails before, a reader gets the model saved before, and what was loaded stays readable (also while it is
    saved again to the same path). With ``epoch`` the save stands for that epoch only; other epochs stay.
    """
    spark = vocab.sparkSession
    kind = next(k for k, cls in MODELS.items() if isinstance(model, cls))
    weights = [float(w) for w in getattr(model, "weights", ())]
    params = spark.createDataFrame([(kind, model.vocab_size, float(model.k), weights)], PARAMS_SCHEMA)
    version = uuid.uuid4().hex
    for name, table in {**model.tables(), "params": params, "vocab": vocab}.items():
        table.write.parquet(f"{path}/versions/{version}/{name}")
    last = saves(spark, path).agg(F.max("no")).first()[0]
    _point(spark, path, (0 if last is None else last + 1, epoch, version))


def _point(spark: SparkSession, path: str, save: tuple) -> None:
    spark.createDataFrame([save], SAVES_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/saves")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def saves(spark: SparkSession, path: str) -> DataFrame:
    """(no, epoch, version) of every save that ended, in the order of ``no``."""
    store, folder = _folder(spark, f"{path}/saves")
    return spark.read.schema(SAVES_SCHEMA).parquet(f"{path}/saves") if store.exists(folder) else spark.createDataFrame([], SAVES_SCHEMA)


def load_model(spark: SparkSession, path: str, epoch: int | None = None) -> tuple[Model, DataFrame]:
    """The model saved last (for ``epoch``, if given) and the vocabulary beside it."""
    ended = saves(spark, path)
    last = (ended if epoch is None else ended.filter(F.col("epoch") == epoch)).orderBy(F.desc("no")).first()
    if last is None:
        raise ValueError(f"no model in {path}" + (f" for epoch {epoch}" if epoch is not None else ""))
    folder = f"{path}/versions/{last['version']}"
    params = spark.read.parquet(f"{folder}/params").first()
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES[params["kind"]]}
    extra = {"weights": tuple(params["weights"])} if params["weights"] else {}
    model = MODELS[params["kind"]](**tables, vocab_size=params["vocab_size"], k=params["k"], **extra)
    return model, spark.read.parquet(f"{folder}/vocab")


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Delete the versions that no later load can ask for. Models loaded from them must not be in use any more."""
    ended = [(r["no"], r["epoch"], r["version"]) for r in saves(spark, path).collect()]
    newest = {epoch: max(no for no, e, _ in ended if e == epoch) for _, epoch, _ in ended}
    for no, epoch, version in ended:
        if no < newest[epoch]:
            store, folder = _folder(spark, f"{path}/versions/{version}")
            store.delete(folder, True)


def start_run(spark: SparkSession, path: str, run_id: str, arguments: dict) -> None:
    """Empty the log of ``run_id`` and write its arguments as the first entries."""
    # The start itself is an entry, so that a run without arguments empties the log too.
    rows = [(run_id, "start", None, None, None, None)]
    rows += [(run_id, "argument", None, k, float(v) if _is_number(v) else None, str(v)) for k, v in arguments.items()]
    _log_writer(spark.createDataFrame(rows, LOG_SCHEMA), "overwrite").parquet(path)


def log_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append (epoch, name, value) rows to the log."""
    rows = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit("metric").alias("kind"),
        F.col("epoch").cast("int").alias("epoch"),
        "name",
        F.col("value").cast("double").alias("value"),
        F.lit(None).cast("string").alias("text"),
    )
    _log_writer(rows, "append").parquet(path)


def _is_number(value: object) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _log_writer(df: DataFrame, mode: str):
    return df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("run_id")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def write_shards(batches: DataFrame, path: str) -> None:
    """One folder per worker; batches come from :func:`lexmill.operators.batching.shard_batches`."""
    batches.write.mode("overwrite").partitionBy("shard").parquet(path)
