"""From raw documents to packed sequences: five stages, each written and read again as the next one's documents.

1. ``quality``: documents that the quality model rejects go. It learns from the labels of the corpus as it came.
2. ``near_duplicates``: of each component of documents with five-word shingles 80 % alike, the smallest id stays.
3. ``passages``: passages of 50 words and more that an earlier document has too are cut out; what is left of a
   document stays, unless nothing is.
4. ``decontamination``: documents that hold a window of ten words of a benchmark item go.
5. ``packing``: the rest is tokenized and packed into sequences of 2,048 tokens.

All but the last stage return the columns of their input. Every stage works on all its predecessor kept, with the columns
``doc_id`` and ``text``; further columns are handed through untouched (``n_chars`` follows a cut text). Rows with a null
id have no labels and no duplicates and stay unless another rule takes them; null or empty texts are judged by the quality model
like any other text; rows that repeat an id are one document and leave stage 2 as one row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm import decontaminate, minhash, pack, passages, quality

#: No stage can be said in SQL as a whole (trained model, chaining, tokenizer); tests/llm holds it against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(spark, docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    # Rows that repeat an id are rare; only they are shuffled with their texts.
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = materialize(repeated, "repeated-ids")
    kept = docs.join(gone.unionByName(repeated).distinct(), "doc_id", "left_anti").select(*docs.columns)
    once = docs.join(repeated.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi").select(*docs.columns)
    return kept.unionByName(once.dropDuplicates(["doc_id"]))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passages.remove_passages(docs, passages.passages(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
