"""From raw documents to a training mix, in five stages.

Quality rules drop documents; line dedup takes boilerplate lines out; MinHash
near-dedup leaves one document of each class; decontamination drops documents
with benchmark items; mixing takes documents, in whole epochs and a rest, up to
the target weights.  Each stage gets what the one before kept.  All but the
last return the columns of ``documents``; the last adds the mix columns.

A stage's result goes to Parquet in the shared scratch folder and is read back,
so a lost executor repeats work of one stage at most.  Empty tables, null
fields, repeated rows and extra columns follow the operators' own rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plantframe.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from plantframe.llm._scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are boilerplate of their source; n_chars follows the text."""
    return line_dedup.drop_boilerplate(docs, "source", length="n_chars")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with domain, tokens and number of copies."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]

#: Near-duplicate classes are components of a similarity graph and have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
