"""Train/test splits by time and mean-centring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.operators.ranking import with_group_rank, with_position
from ratingmill.params import DEFAULTS


def split_per_user(
    ratings: DataFrame,
    train_parts: int = DEFAULTS.train_parts,
    all_parts: int = DEFAULTS.all_parts,
    hot_rows: int = DEFAULTS.hot_group_rows,
    bound: DataFrame | None = None,
) -> DataFrame:
    """The oldest share of every user's ratings is training data; adds ``is_train``."""
    ranked = with_group_rank(ratings, "userId", ["timestamp", "movieId"], hot_rows, bound=bound)
    inside = F.col("rank") * all_parts <= F.col("count") * train_parts
    return ranked.withColumn("is_train", inside).drop("rank", "count")


def split_global(
    ratings: DataFrame,
    train_parts: int = DEFAULTS.train_parts,
    all_parts: int = DEFAULTS.all_parts,
) -> DataFrame:
    """The oldest ``floor(n * share)`` rows of all are training data; adds ``is_train``."""
    placed = with_position(ratings, ["timestamp", "userId", "movieId"])
    cut = placed.count() * train_parts // all_parts
    return placed.select(*ratings.columns, (F.col("position") <= cut).alias("is_train"))


def train_rows(split: DataFrame) -> DataFrame:
    return split.filter("is_train").drop("is_train")


def test_rows(split: DataFrame) -> DataFrame:
    return split.filter(~F.col("is_train")).drop("is_train")


def user_means(train: DataFrame) -> DataFrame:
    return train.groupBy("userId").agg(F.avg("rating").alias("user_mean_rating"))


def centre(rows: DataFrame, means: DataFrame, default: float | None = None) -> DataFrame:
    """Rating minus the user's training mean; users without one get ``default`` or null."""
    joined = rows.join(means, "userId", "left")
    if default is not None:
        joined = joined.na.fill({"user_mean_rating": default})
    return joined.withColumn("normalized_rating", F.col("rating") - F.col("user_mean_rating"))
