"""Documents to a training mix: five stages, each written and read again before the next one.

Toxic documents go, then all but the first of equal texts, then all but one of each group of near copies, then documents
that contain benchmark items; the last stage says how many words of each remaining document the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingmill.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from ratingmill.session import stage


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``decided`` (doc_id, kept) drops; a row without doc_id stays."""
    return docs.join(decided.filter("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, exact_dedup.exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, near_dedup.near_dedup(docs))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: doc_id, source, size, source_size, target, taken (words, repeats counted) of documents it takes."""
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("source mixing", mix_sources),
]

# A trained model, likelihood estimates and components have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
