"""Registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import decontaminate, graph_ann, html_text, minhash, pack, passages, quality, ranked_search, token_count, token_files, toxicity, vector_codes, warc

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.packed_documents(spark, sf_dir, BYTE_BPE)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.document_tokens(spark, sf_dir, BYTE_BPE)


def op13_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.stored_documents(spark, sf_dir, BYTE_BPE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.toxicity,
    "op2_quality_gam": quality.quality,
    "op3_robust_pruned_graph": graph_ann.nearest,
    "op4_sum_of_squares_packing": op4_sum_of_squares_packing,
    "op5_warc_chunks": warc.archived_pages,
    "op6_token_counts": op6_token_counts,
    "op7_collinear_passages": passages.repeated_passages,
    "op8_html_main_text": html_text.page_texts,
    "op9_bbit_minhash": minhash.near_duplicate_classes,
    "op10_benchmark_decontamination": decontaminate.contamination,
    "op11_hilbert_blocks": vector_codes.coded_embeddings,
    "op12_max_sketch_search": ranked_search.ranked_documents,
    "op13_orc_token_files": op13_orc_token_files,
}

#: SQL for those that it can express.
ORACLES: dict[str, str] = {
    "op5_warc_chunks": warc.ORACLE,
    "op11_hilbert_blocks": vector_codes.ORACLE,
    "op12_max_sketch_search": ranked_search.ORACLE,
}
