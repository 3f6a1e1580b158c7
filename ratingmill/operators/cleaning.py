"""Cleaning: sparsity filters, de-duplication, defaults, coercion, raw movie assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators.ranking import top_per_group
from ratingmill.params import DEFAULTS

# Fixed default values of the metadata columns.
METADATA_DEFAULTS = {
    "overview": "",
    "cast": "Unknown",
    "director": "Unknown Director",
    "poster_url": "",
}
FILLER_METADATA = {
    "overview": "Great movie overview.",
    "cast": "Actor A Actor B",
    "director": "Director X",
}


def keep_frequent(ratings: DataFrame, key: str, least: int) -> DataFrame:
    """Rows whose key occurs at least ``least`` times; the count is combined before the shuffle."""
    kept = ratings.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(key)
    return ratings.join(kept, key, "left_semi")


def filter_users_first(
    ratings: DataFrame,
    least_user: int = DEFAULTS.min_user_ratings,
    least_movie: int = DEFAULTS.min_movie_ratings,
) -> DataFrame:
    return keep_frequent(keep_frequent(ratings, "userId", least_user), "movieId", least_movie)


def filter_movies_first(
    ratings: DataFrame,
    least_user: int = DEFAULTS.min_user_ratings,
    least_movie: int = DEFAULTS.min_movie_ratings,
) -> DataFrame:
    return keep_frequent(keep_frequent(ratings, "movieId", least_movie), "userId", least_user)


def sync_movies(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    return movies.join(ratings.select("movieId").distinct(), "movieId", "left_semi")


def drop_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Users and movies removed by a filter, in one aggregate over both versions."""
    keys = ["userId", "movieId"]
    both = before.select(*keys, F.lit(False).alias("_after")).unionByName(
        after.select(*keys, F.lit(True).alias("_after"))
    )

    def removed(key: str) -> Column:
        kept = F.count_distinct(F.when(F.col("_after"), F.col(key)))
        return F.count_distinct(F.when(~F.col("_after"), F.col(key))) - kept

    return both.agg(removed("userId").alias("dropped_users"), removed("movieId").alias("dropped_movies"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key, the first by ``order``; without one the greatest by all other columns."""
    ranks = order or [F.desc_nulls_last(c) for c in df.columns if c not in keys]
    return top_per_group(df, keys, ranks or list(keys), 1, "_rank").drop("_rank")


def clean_movies(movies: DataFrame) -> DataFrame:
    """Distinct movies with trimmed text, genre array, year and decade."""
    trimmed = movies.dropDuplicates().select(
        "movieId", F.trim("title").alias("title"), F.trim("genres").alias("genres")
    )
    year = S.release_year(F.col("title"))
    return trimmed.select(
        "movieId",
        "title",
        "genres",
        S.genre_array(F.col("genres")).alias("genre_list"),
        year.alias("release_year"),
        S.decade(year).alias("decade"),
    )


def fill_metadata(metadata: DataFrame) -> DataFrame:
    return metadata.na.fill({c: v for c, v in METADATA_DEFAULTS.items() if c in metadata.columns})


def raw_movies(movies: DataFrame, links: DataFrame, metadata: DataFrame) -> DataFrame:
    """Movies with external id, release year and metadata, unmatched ones kept; repeated ids in the two others count once."""
    known = first_per_key(links.select("movieId", "tmdbId"), ["movieId"])
    described = first_per_key(metadata.select("movieId", "overview", "cast", "director"), ["movieId"])
    return (
        movies.join(known, "movieId", "left")
        .join(described, "movieId", "left")
        .select(
            "movieId",
            "tmdbId",
            "title",
            "genres",
            S.release_year(F.col("title")).alias("release_year"),
            "overview",
            "cast",
            "director",
        )
    )


def missing_metadata(ids: DataFrame, metadata: DataFrame) -> DataFrame:
    """Ids that no metadata row covers yet."""
    return ids.select("movieId").join(metadata.select("movieId"), "movieId", "left_anti")


def complete_metadata(ids: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata plus filler rows for the ids it lacks."""
    filler = missing_metadata(ids, metadata).select(
        "movieId", *[F.lit(v).alias(c) for c, v in FILLER_METADATA.items()]
    )
    return metadata.select("movieId", *FILLER_METADATA).unionByName(filler)


def search_titles(movies: DataFrame, pattern: str, limit: int = 50) -> DataFrame:
    """Case-insensitive regular-expression search; a null title does not match."""
    hit = F.coalesce(F.col("title").rlike("(?i)" + pattern), F.lit(False))
    return movies.filter(hit).orderBy("movieId").limit(limit)
