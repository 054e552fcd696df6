"""The registered queries of this folder: thin calls of the operators on the given tables, with oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantframe.llm.oracles import ORACLES  # noqa: F401 - read by the registry
from plantframe.llm import decontaminate, hard_negatives, licenses, line_dedup, mixing, near_dedup, quality, rlz_dedup, suffix_dedup, token_counts, toxicity, url_filter, vector_codes

QueryFn = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).withColumns({"unit_no": F.col("unit_no").cast("long"), "dice": F.round("dice", 6)})


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, *toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op5_probminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"), "source", counts=True).select("doc_id", "n_lines", "n_dropped", "text")


def op7_relative_lempel_ziv_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "mix_domain", "mix_tokens", "mix_copies")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages")).drop("globs")


def op11_vector_dictionary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(_table(spark, sf_dir, "embeddings"))


def op12_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_hilbert_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_quality_rules, op3_license_scan, op4_toxicity, op5_probminhash_near_dedup, op6_line_dedup,
    op7_relative_lempel_ziv_dedup, op8_suffix_array_dedup, op9_source_mixing, op10_url_filter, op11_vector_dictionary_codes,
    op12_heap_token_counts, op13_hilbert_hard_negatives)}

