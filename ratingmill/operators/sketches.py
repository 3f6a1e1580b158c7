"""Distinct counts from stored, mergeable sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S

LOG_SIZE = 14  # 2^14 registers: a standard error below 1 %


def daily_sketches(ratings: DataFrame, log_size: int = LOG_SIZE) -> DataFrame:
    """(day, users, movies): one sketch of each per day; a new day adds rows and changes none."""
    day = S.epoch_date(F.col("timestamp")).alias("day")
    return ratings.groupBy(day).agg(F.hll_sketch_agg("userId", log_size).alias("users"), F.hll_sketch_agg("movieId", log_size).alias("movies"))


def distinct_in(sketches: DataFrame, period: Column) -> DataFrame:
    """(period, users, movies): estimates per period of days, from the sketches alone."""
    merged = sketches.groupBy(period.alias("period"))
    return merged.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("users", "movies")])
