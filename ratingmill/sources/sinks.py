"""Sinks: whole-table writes, appends, JSON reports and upserts by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ratingmill.operators.cleaning import first_per_key


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Each batch adds its own files; nothing that is already there is rewritten."""
    df.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A short text, such as a summary table, as one file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Drop and recreate every table of a warehouse as parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_tables(spark: SparkSession, names: Sequence[str], folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same key, new keys are added.

    Of updates that share a key the first by ``order`` counts; without one the greatest by all other columns.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return first_per_key(updates, keys, order).unionByName(kept)
