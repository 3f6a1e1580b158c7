"""Profiles of users, movies, genres and ratings, and data-quality summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators.quantiles import quantile
from ratingmill.operators.ranking import with_position
from ratingmill.params import DEFAULTS


def count_per(df: DataFrame, key: str, name: str = "rating_count") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def user_behaviour(train: DataFrame) -> DataFrame:
    """Mean, sample deviation (0 for a single rating) and count per user."""
    return train.groupBy("userId").agg(
        F.avg("rating").alias("mean_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("std_rating"),
        F.count("rating").alias("rating_count"),
    )


def distinct_counts(ratings: DataFrame) -> DataFrame:
    return ratings.agg(
        F.count_distinct("userId").alias("users"),
        F.count_distinct("movieId").alias("movies"),
        F.count("*").alias("ratings"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


def rating_moments(ratings: DataFrame) -> DataFrame:
    """Mean, exact median and deviation; pass a staged table, the median reads it several times."""
    return ratings.agg(
        F.avg("rating").alias("mean_rating"),
        F.lit(quantile(ratings, "rating", 0.5)).alias("median_rating"),
        F.stddev_samp("rating").alias("std_rating"),
    )


def percentile(df: DataFrame, column: str, share: float, name: str) -> DataFrame:
    """Exact percentile with linear interpolation: one row. Pass a staged table, it is read several times."""
    return df.agg(F.lit(quantile(df, column, share)).cast("double").alias(name))


def genre_frequency(movies: DataFrame) -> DataFrame:
    """Movies per genre name as written, the empty one included."""
    return count_per(movies.select(F.explode(F.split("genres", r"\|")).alias("genre")), "genre", "movies")


def genre_popularity(movies: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent known genres."""
    names = movies.select(F.explode(S.genre_array(F.col("genres"))).alias("genre"))
    return count_per(names, "genre", "movies").orderBy(F.desc("movies"), "genre").limit(limit)


def yearly_average(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy(F.year(S.epoch_date(F.col("timestamp"))).alias("year")).agg(
        F.avg("rating").alias("avg_rating"), F.count("*").alias("rating_count")
    )


def sparsity(ratings: DataFrame) -> DataFrame:
    cells = F.count_distinct("userId") * F.count_distinct("movieId")
    return ratings.agg((1 - F.try_divide(F.count("*").cast("double"), cells)).alias("sparsity"))


def histogram(values: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the top edge is in the last bin."""
    low, high = values.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return values.sparkSession.createDataFrame([], "bin int, bin_start double, frequency bigint")
    width = (high - low) / bins
    index = F.floor((F.col(column) - F.lit(low)) / F.lit(width)) if width else F.lit(0)
    bin_ = (F.least(index, F.lit(bins - 1)) + 1).cast("int").alias("bin")
    counts = values.filter(F.col(column).isNotNull()).groupBy(bin_).agg(F.count("*").alias("frequency"))
    return counts.select("bin", (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"), "frequency")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent per column, in one pass over the data."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    long = counts.unpivot("_rows", names, "column_name", "missing")
    return long.select(
        "column_name",
        "missing",
        S.safe_ratio(F.col("missing") * 100.0, F.col("_rows")).alias("missing_percent"),
    )


def null_overview(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Null counts of two tables side by side, columns of either kept."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return null_profile(df).select("column_name", F.col("missing").alias(f"missing_{name}"))

    return side(left, left_name).join(side(right, right_name), "column_name", "full")


def long_tail(train: DataFrame, movies: DataFrame, titled: int = 5) -> DataFrame:
    """Movies by rating count with their rank; the first ones carry their title."""
    ranked = with_position(count_per(train, "movieId"), [F.desc("rating_count"), "movieId"], "rank")
    head = F.col("rank") <= titled
    named = (
        ranked.filter(head)
        .join(movies.select("movieId", "title"), "movieId", "left")
        .select("movieId", "rating_count", "rank", "title")
    )
    return named.unionByName(ranked.filter(~head).withColumn("title", F.lit(None).cast("string")))


def activity_by_genre(train: DataFrame, dim_movie: DataFrame, top: int = 12) -> DataFrame:
    """Mean rating per activity band and primary genre, most frequent genres only, long form."""
    counts = count_per(train, "userId")
    rows = (
        train.join(counts, "userId")
        .join(dim_movie.select(F.col("movie_id").alias("movieId"), "primary_genre"), "movieId", "left")
        .filter(F.col("primary_genre").isNotNull())
        .groupBy(S.activity_band(F.col("rating_count")).alias("activity"), "primary_genre")
        .agg(F.sum("rating").alias("_sum"), F.count("*").alias("_n"))
    )
    # One row per band and genre from here on.
    frequent = rows.groupBy("primary_genre").agg(F.sum("_n").alias("_total"))
    chosen = frequent.orderBy(F.desc("_total"), "primary_genre").limit(top).select("primary_genre")
    return rows.join(chosen, "primary_genre", "left_semi").select(
        "activity", "primary_genre", (F.col("_sum") / F.col("_n")).alias("avg_rating")
    )


def crosstab(long: DataFrame, genres: Sequence[str] | None = None) -> DataFrame:
    """Activity bands as rows, genres as columns, 0 where there is no rating."""
    grouped = long.groupBy("activity")
    columns = grouped.pivot("primary_genre", list(genres)) if genres else grouped.pivot("primary_genre")
    return columns.agg(F.first("avg_rating")).na.fill(0.0)


def other_bucket(dim_movie: DataFrame, top: int = 6, other: str = "Other") -> DataFrame:
    """Every movie with its primary genre, genres outside the ``top`` most frequent renamed."""
    frequent = count_per(dim_movie, "primary_genre", "_n").orderBy(F.desc("_n"), "primary_genre").limit(top)
    # At most ``top`` rows.
    chosen = F.broadcast(frequent.select("primary_genre", F.col("primary_genre").alias("_kept")))
    return dim_movie.join(chosen, "primary_genre", "left").select(
        "movie_id", "primary_genre", F.coalesce("_kept", F.lit(other)).alias("genre_bucket")
    )


def genre_cooccurrence(
    train: DataFrame, dim_movie: DataFrame, threshold: float = DEFAULTS.network_threshold
) -> DataFrame:
    """Users per unordered pair of liked primary genres.

    A user's genres are first reduced to one sorted set, and equal sets are counted together, so
    pairs are formed once per different set instead of once per user. A set is at most as long
    as the list of genre names.
    """
    liked = train.filter(F.col("rating") >= threshold).select("userId", "movieId")
    genres = dim_movie.select(F.col("movie_id").alias("movieId"), "primary_genre")
    per_user = liked.join(genres, "movieId").select("userId", "primary_genre").distinct()
    sets = (
        per_user.groupBy("userId")
        .agg(F.array_sort(F.collect_set("primary_genre")).alias("genre_set"))
        .groupBy("genre_set")
        .agg(F.count("*").alias("users"))
    )
    firsts = sets.select("genre_set", "users", F.posexplode("genre_set").alias("place", "genre_a"))
    pairs = firsts.select(
        "genre_a", F.explode(F.expr("slice(genre_set, place + 2, size(genre_set))")).alias("genre_b"), "users"
    )
    return pairs.groupBy("genre_a", "genre_b").agg(F.sum("users").alias("weight"))


def strong_edges(pairs: DataFrame, share: float = 0.85) -> DataFrame:
    """Pairs whose weight reaches the given percentile of all weights."""
    cut = percentile(pairs, "weight", share, "cut").first()["cut"]
    return pairs.filter(F.col("weight") >= F.lit(cut))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Degree over (nodes - 1); one row per genre."""
    ends = edges.select(F.col("genre_a").alias("genre")).unionAll(edges.select(F.col("genre_b").alias("genre")))
    degrees = count_per(ends, "genre", "degree")
    # One row per genre name, so the unpartitioned window is small.
    nodes = F.count("*").over(Window.partitionBy())
    return degrees.select("genre", "degree", S.safe_ratio(F.col("degree").cast("double"), nodes - 1, 1.0).alias("centrality"))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "score") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def metric_rows(df: DataFrame, section: str, values: Sequence[str]) -> DataFrame:
    """A one-row summary as rows ``(section, metric, value)``."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in values])
    return typed.unpivot([], list(values), "metric", "value").select(F.lit(section).alias("section"), "metric", "value")


def quality_summary(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Sizes, rating range and nulls of both tables as ``(section, metric, value)``."""
    summary = distinct_counts(ratings).select("users", "movies", "ratings", "min_rating", "max_rating")
    parts = metric_rows(summary, "summary", summary.columns)
    for name, df in (("ratings", ratings), ("movies", movies)):
        nulls = null_profile(df).select(
            F.lit(f"missing_{name}").alias("section"),
            F.col("column_name").alias("metric"),
            F.col("missing").cast("double").alias("value"),
        )
        parts = parts.unionByName(nulls)
    return parts


def column_types(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Type and number of known values of every column: (table_name, column_name, column_type, known)."""
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    parts = []
    for name, df in tables.items():
        types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, names.get(t, t.upper()))])
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "known")
        parts.append(counts.select(F.lit(name).alias("table_name"), "column_name", types[F.col("column_name")].alias("column_type"), "known"))
    return reduce(DataFrame.unionByName, parts)


def collection_summary(movies: DataFrame, ratings: DataFrame, attempts: DataFrame) -> DataFrame:
    """Sizes, date range and share of enrichment attempts with any text, 100 without attempts."""
    sizes = ratings.agg(
        F.count("*").alias("total_ratings"),
        F.count_distinct("userId").alias("unique_users"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) != ""

    any_text = filled("overview") | filled("cast") | filled("director")
    success = attempts.agg(S.safe_ratio(F.count_if(any_text) * 100.0, F.count("*"), 100.0).alias("success_percent"))
    total = movies.agg(F.count("*").alias("total_movies"))
    parts = metric_rows(total, "collection", total.columns)
    parts = parts.unionByName(metric_rows(sizes, "collection", sizes.columns))
    return parts.unionByName(metric_rows(success, "collection", success.columns))
