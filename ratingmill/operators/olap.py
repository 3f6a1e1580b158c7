"""Cube operators: aggregates of the rating fact along movie, user and time attributes.

Every operator reads only the tables whose attributes it uses. Sums and counts are formed per movie before any movie
attribute is joined, so the join meets one row per movie and no rating is shuffled twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def _mean() -> Column:
    return F.round(F.sum("_sum") / F.sum("_n"), 2)


def _per_movie(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movie_id").agg(F.sum("rating").alias("_sum"), F.count("rating").alias("_n"))


def _totals(cube: Mapping[str, DataFrame], members: Column, *attributes: str) -> DataFrame:
    """Rating sums and counts of the movies that ``members`` selects, with some attributes."""
    movies = cube["movie"].filter(members).select("movie_id", *attributes)
    return _per_movie(cube["rating"]).join(movies, "movie_id")


def overall_average(cube: Mapping[str, DataFrame]) -> DataFrame:
    return cube["rating"].agg(F.round(F.avg("rating"), 2).alias("avg_rating"))


def genre_average(cube: Mapping[str, DataFrame], genre: str) -> DataFrame:
    return _totals(cube, F.col("primary_genre") == genre).agg(_mean().alias("avg_rating"))


def rollup(cube: Mapping[str, DataFrame], levels: Sequence[str] = ("primary_genre", "decade")) -> DataFrame:
    """Average and number of ratings at some levels of the movie dimension, known genres only."""
    totals = _totals(cube, F.col("primary_genre") != UNKNOWN, *levels)
    return totals.groupBy(*levels).agg(_mean().alias("avg_rating"), F.sum("_n").alias("rating_count")).orderBy(*levels)


def drilldown(cube: Mapping[str, DataFrame], genre: str, least: int = 50, limit: int = 10) -> DataFrame:
    """Best titles of a genre with at least ``least`` ratings; movies of equal title are one."""
    by_title = _totals(cube, F.col("primary_genre") == genre, "title").groupBy("title")
    scored = by_title.agg(_mean().alias("movie_avg"), F.sum("_n").alias("total_ratings"))
    return scored.filter(F.col("total_ratings") >= least).orderBy(F.desc("movie_avg"), "title").limit(limit)


def slice_genre(cube: Mapping[str, DataFrame], genre: str, limit: int = 15) -> DataFrame:
    """Best, then oldest ratings of a genre with the activity of their users.

    The rows are chosen before the user dimension is joined.
    """
    movies = cube["movie"].filter(F.col("primary_genre") == genre).select("movie_id", "title")
    order = (F.desc("rating"), F.col("year"), F.col("title"), F.col("user_id"), F.col("movie_id"))
    dated = cube["rating"].withColumn("year", F.year("full_date")).join(movies, "movie_id")
    chosen = dated.orderBy(*order).limit(limit)
    users = cube["user"].select("user_id", "activity_level")
    return chosen.join(users, "user_id").orderBy(*order).select("title", "year", "rating", "activity_level")


def dice(
    cube: Mapping[str, DataFrame],
    genres: Sequence[str],
    after_year: int = 2000,
    above_rating: float = 4.0,
    limit: int = 20,
) -> DataFrame:
    """Most rated titles of some genres, recent years and high ratings."""
    attributes = ("title", "primary_genre", "release_year")
    high = {**cube, "rating": cube["rating"].filter(F.col("rating") > above_rating)}
    members = F.col("primary_genre").isin(*genres) & (F.col("release_year") > after_year)
    counted = _totals(high, members, *attributes).groupBy(*attributes).agg(F.sum("_n").alias("popularity_count"))
    return counted.orderBy(F.desc("popularity_count"), *attributes).limit(limit)


def pivot(rolled: DataFrame, decades: Sequence[str] | None = None) -> DataFrame:
    """Genres as rows, decades as columns; a missing cell stays null.

    Give the decades to save the job that looks them up.
    """
    grouped = rolled.groupBy("primary_genre")
    columns = grouped.pivot("decade", list(decades)) if decades else grouped.pivot("decade")
    return columns.agg(F.first("avg_rating"))
