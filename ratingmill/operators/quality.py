"""Integrity checks over the training data and the warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.sources.readers import require_columns
from ratingmill.sources.schemas import REQUIRED


def train_contract(train: DataFrame) -> DataFrame:
    """Required columns are present (raises otherwise); rows and null ratings."""
    checked = require_columns(train, REQUIRED["ratings"], "train")
    return checked.agg(F.count("*").alias("row_count"), F.count_if(F.col("rating").isNull()).alias("null_ratings"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def orphan_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose user, movie or time key has no dimension row."""
    fact = tables["fact_rating"]
    checks = []
    for dim, key in (("dim_user", "user_id"), ("dim_movie", "movie_id"), ("dim_time", "time_id")):
        orphans = fact.select(key).join(tables[dim].select(key), key, "left_anti")
        checks.append(orphans.agg(F.count("*").alias("orphans")).select(F.lit(key).alias("foreign_key"), "orphans"))
    return reduce(DataFrame.unionByName, checks)
