"""Star schema: four dimensions and the rating fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators.ranking import with_position
from ratingmill.operators.splitting import centre, train_rows, user_means

TABLES = ("dim_user", "dim_movie", "dim_genre", "dim_time", "fact_rating")


def _number(key: str) -> Column:
    """Surrogate key in sorted order. Only for the distinct days and genre names, whose number
    the calendar and the genre list bound; one task numbers them."""
    return F.row_number().over(Window.orderBy(key)).cast("bigint")


def dim_user(split: DataFrame, scope: str = "all") -> DataFrame:
    """Count, mean and activity per user, over all ratings or the training ratings."""
    rows = split if scope == "all" else split.filter("is_train")
    stats = rows.groupBy("userId").agg(F.count("*").alias("rating_count"), F.avg("rating").alias("avg_rating"))
    return stats.select(
        F.col("userId").alias("user_id"),
        F.lit(None).cast("bigint").alias("user_index"),
        "rating_count",
        "avg_rating",
        S.activity_level(F.col("rating_count")).alias("activity_level"),
    )


def dim_movie(movies: DataFrame, links: DataFrame | None = None, metadata: DataFrame | None = None) -> DataFrame:
    """One row per movie. Repeated ids in links or metadata count once (the greatest external id, the longest overview), and
    as both are grouped by the id, Spark drops their joins where no column of theirs is read."""
    rows = movies
    if links is not None:
        rows = rows.join(links.groupBy("movieId").agg(F.max("tmdbId").alias("tmdbId")), "movieId", "left")
    else:
        rows = rows.withColumn("tmdbId", F.lit(None).cast("bigint"))
    if metadata is not None:
        lengths = metadata.groupBy("movieId").agg(F.max(S.text_length(F.col("overview"))).alias("_length"))
        rows = rows.join(lengths, "movieId", "left")
    else:
        rows = rows.withColumn("_length", F.lit(None).cast("int"))
    year = S.release_year(F.col("title"))
    return rows.select(
        F.col("movieId").alias("movie_id"),
        F.col("tmdbId").alias("tmdb_id"),
        "title",
        year.alias("release_year"),
        S.decade(year).alias("decade"),
        S.primary_genre(F.col("genres")).alias("primary_genre"),
        F.col("genres").alias("all_genres"),
        F.coalesce("_length", F.lit(0)).alias("overview_length"),
    )


def dim_genre(movies: DataFrame) -> DataFrame:
    names = movies.select(F.explode(F.split("genres", r"\|")).alias("genre_name"))
    distinct = names.select(F.trim("genre_name").alias("genre_name")).filter("genre_name <> ''").distinct()
    return distinct.select(_number("genre_name").alias("genre_id"), "genre_name")


def dim_time(ratings: DataFrame) -> DataFrame:
    days = ratings.select(S.epoch_date(F.col("timestamp")).alias("full_date")).na.drop().distinct()
    return days.select(
        _number("full_date").alias("time_id"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        F.weekday("full_date").alias("day_of_week"),
        (F.weekday("full_date") >= 5).alias("is_weekend"),
    )


def fact_rating(split: DataFrame, times: DataFrame, default_mean: float | None = 0.0) -> DataFrame:
    """One row per rating with its time key and the rating centred on the training mean.

    ``fact_id`` is the position in the order of user, movie and time: unique, and the same in every run.
    """
    placed = with_position(split, ["userId", "movieId", "timestamp"], "fact_id")
    rows = centre(placed, user_means(train_rows(split)), default_mean)
    dated = rows.withColumn("full_date", S.epoch_date(F.col("timestamp")))
    return dated.join(times.select("time_id", "full_date"), "full_date", "left").select(
        "fact_id",
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        "time_id",
        "rating",
        "normalized_rating",
        "is_train",
    )


def build_cube(
    ratings: DataFrame,
    movies: DataFrame,
    links: DataFrame | None = None,
    metadata: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """What cube queries read, straight from the ratings: no split, no surrogate keys; days are joined by date."""
    day = S.epoch_date(F.col("timestamp"))
    facts = ratings.select(F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), day.alias("full_date"), "rating")
    return {"rating": facts, "movie": dim_movie(movies, links, metadata), "user": dim_user(ratings)}


def build_warehouse(
    split: DataFrame,
    movies: DataFrame,
    links: DataFrame | None = None,
    metadata: DataFrame | None = None,
) -> dict[str, DataFrame]:
    times = dim_time(split)
    return {
        "dim_user": dim_user(split),
        "dim_movie": dim_movie(movies, links, metadata),
        "dim_genre": dim_genre(movies),
        "dim_time": times,
        "fact_rating": fact_rating(split, times),
    }
