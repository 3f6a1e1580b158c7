"""Queries: profiles, exploration aggregates and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators import profile, sketches, warehouse
from ratingmill.plans.base import lazy_train, query, sql, train_of
from ratingmill.session import stage
from ratingmill.sources import tables as T


def _dim_movie(spark, folder):
    return warehouse.dim_movie(T.movies(spark, folder))


@query(sql("SELECT movieId, count(*) AS rating_count FROM ratings GROUP BY 1", "ratings"))
def ratings_per_movie(spark, folder):
    return profile.count_per(T.ratings(spark, folder), "movieId")


@query(
    sql(
        """SELECT userId, avg(rating) AS mean_rating, round(coalesce(stddev_samp(rating), 0), 6) AS std_rating,
             count(rating) AS rating_count FROM train GROUP BY userId""",
        "train",
    )
)
def user_behaviour(spark, folder):
    return profile.user_behaviour(lazy_train(spark, folder)).withColumn("std_rating", S.rounded(F.col("std_rating")))


@query(
    sql(
        """SELECT CASE WHEN n < 50 THEN 'Low' WHEN n < 500 THEN 'Medium' ELSE 'High' END AS level,
             CASE WHEN n < 20 THEN 'Low (<20)' WHEN n < 100 THEN 'Medium (20-100)' ELSE 'High (>100)' END AS band,
             count(*) AS users FROM (SELECT userId, count(*) AS n FROM ratings GROUP BY 1) GROUP BY 1, 2""",
        "ratings",
    )
)
def activity_buckets(spark, folder):
    n = F.col("rating_count")
    counts = profile.count_per(T.ratings(spark, folder), "userId")
    return counts.groupBy(S.activity_level(n).alias("level"), S.activity_band(n).alias("band")).agg(
        F.count("*").alias("users")
    )


@query(
    sql(
        """SELECT count(DISTINCT userId) AS users, count(DISTINCT movieId) AS movies, count(*) AS ratings,
             min(rating) AS min_rating, max(rating) AS max_rating, min(ts) AS first_timestamp, max(ts) AS last_timestamp
           FROM ratings""",
        "ratings",
    )
)
def distinct_counts_and_ranges(spark, folder):
    return profile.distinct_counts(T.ratings(spark, folder))


@query(
    sql(
        "SELECT avg(rating) AS mean_rating, median(rating) AS median_rating, round(stddev_samp(rating), 6) AS std_rating FROM ratings",
        "ratings",
    )
)
def rating_moments(spark, folder):
    return profile.rating_moments(stage(T.ratings(spark, folder).select("rating"), "ratings")).withColumn("std_rating", S.rounded(F.col("std_rating")))


@query(sql("SELECT rating, count(*) AS n FROM ratings GROUP BY 1", "ratings"))
def rating_value_counts(spark, folder):
    return profile.count_per(T.ratings(spark, folder), "rating", "n")


def _histogram_sql(source: str, column: str, bins: int, need: str) -> str:
    return sql(
        f"""SELECT CAST(b AS INTEGER) AS bin, round(low + (b - 1) * w, 6) AS bin_start, count(*) AS frequency
           FROM (SELECT coalesce(least(floor(({column} - low) / nullif(w, 0)), {bins} - 1), 0) + 1 AS b, low, w
                 FROM {source}, (SELECT min({column})::DOUBLE AS low, (max({column})::DOUBLE - min({column})) / {bins} AS w FROM {source}))
           GROUP BY b, low, w""",
        need,
    )


def _rounded_bins(df):
    return df.withColumn("bin_start", S.rounded(F.col("bin_start")))


@query(_histogram_sql("train", "rating", 10, "train"))
def rating_histogram(spark, folder):
    return _rounded_bins(profile.histogram(train_of(spark, folder), "rating", 10))


@query(_histogram_sql("(SELECT count(*) AS n FROM ratings GROUP BY userId)", "n", 100, "ratings"))
def user_count_histogram(spark, folder):
    return _rounded_bins(profile.histogram(profile.count_per(T.ratings(spark, folder), "userId", "n"), "n", 100))


@query(_histogram_sql("(SELECT count(*) AS n FROM ratings GROUP BY movieId)", "n", 100, "ratings"))
def movie_count_histogram(spark, folder):
    return _rounded_bins(profile.histogram(profile.count_per(T.ratings(spark, folder), "movieId", "n"), "n", 100))


@query(sql("SELECT unnest(string_split(genres, '|')) AS genre, count(*) AS movies FROM movies GROUP BY 1", "movies"))
def genre_frequency(spark, folder):
    return profile.genre_frequency(T.movies(spark, folder))


@query(sql("SELECT genre, count(*) AS movies FROM movie_genres GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "movie_genres"))
def genre_popularity(spark, folder):
    return profile.genre_popularity(T.movies(spark, folder))


@query(
    sql(
        """SELECT CAST(year(DATE '1970-01-01' + CAST(ts // 86400 AS INTEGER)) AS INTEGER) AS year,
             avg(rating) AS avg_rating, count(*) AS rating_count FROM ratings GROUP BY 1""",
        "ratings",
    )
)
def yearly_average(spark, folder):
    return profile.yearly_average(T.ratings(spark, folder))


@query(
    sql(
        "SELECT round(1 - count(*)::DOUBLE / (count(DISTINCT userId) * count(DISTINCT movieId)), 6) AS sparsity FROM ratings",
        "ratings",
    )
)
def sparsity(spark, folder):
    return profile.sparsity(T.ratings(spark, folder)).select(S.rounded(F.col("sparsity")).alias("sparsity"))


_NULLS = "SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percent FROM metadata"


@query(sql(" UNION ALL ".join(_NULLS.format(c=c) for c in ("movieId", "overview", '"cast"', "director")).replace("'\"cast\"'", "'cast'"), "metadata"))
def null_profile(spark, folder):
    rows = profile.null_profile(T.metadata(spark, folder))
    return rows.withColumn("missing_percent", S.rounded(F.col("missing_percent")))


@query(
    sql(
        """SELECT coalesce(l.c, r.c) AS column_name, l.n AS missing_links, r.n AS missing_metadata
           FROM (SELECT unnest(['movieId', 'imdbId', 'tmdbId']) AS c,
                   unnest([count(*) - count(movieId), count(*) - count(imdbId), count(*) - count(tmdbId)]) AS n FROM links) l
           FULL JOIN (SELECT unnest(['movieId', 'overview', 'cast', 'director']) AS c,
                   unnest([count(*) - count(movieId), count(*) - count(overview), count(*) - count("cast"), count(*) - count(director)]) AS n
                 FROM metadata) r ON l.c = r.c""",
        "links", "metadata",
    )
)
def null_overview(spark, folder):
    return profile.null_overview(T.links(spark, folder), T.metadata(spark, folder), "links", "metadata")


@query(
    sql(
        """SELECT movieId, rating_count, rank, CASE WHEN rank <= 5 THEN title END AS title
           FROM (SELECT movieId, count(*) AS rating_count, row_number() OVER (ORDER BY count(*) DESC, movieId) AS rank
                 FROM train GROUP BY movieId) LEFT JOIN movies USING (movieId)""",
        "train", "movies",
    )
)
def long_tail(spark, folder):
    return profile.long_tail(lazy_train(spark, folder), T.movies(spark, folder))


_GENRES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "Unknown")


@query(
    sql(
        "SELECT activity, "
        + ", ".join(f"coalesce(avg(CASE WHEN primary_genre = '{g}' THEN rating END), 0) AS \"{g}\"" for g in _GENRES)
        + """ FROM (SELECT primary_genre, rating, CASE WHEN n < 20 THEN 'Low (<20)' WHEN n < 100 THEN 'Medium (20-100)'
                      ELSE 'High (>100)' END AS activity
                    FROM (SELECT *, count(*) OVER (PARTITION BY userId) AS n FROM train)
                      JOIN dim_movie ON movie_id = movieId) GROUP BY 1""",
        "train", "dim_movie",
    )
)
def activity_genre_crosstab(spark, folder):
    long = profile.activity_by_genre(train_of(spark, folder), _dim_movie(spark, folder))
    return profile.crosstab(long, _GENRES)


@query(
    sql(
        """SELECT movie_id, primary_genre, coalesce(kept, 'Other') AS genre_bucket FROM dim_movie LEFT JOIN
             (SELECT primary_genre, primary_genre AS kept FROM dim_movie GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6) USING (primary_genre)""",
        "dim_movie",
    )
)
def other_bucket(spark, folder):
    return profile.other_bucket(_dim_movie(spark, folder))


_PAIRS = """g AS (SELECT DISTINCT userId, primary_genre AS p FROM train JOIN dim_movie ON movie_id = movieId WHERE rating >= 4.0),
pairs AS (SELECT a.p AS genre_a, b.p AS genre_b, count(*) AS weight FROM g a JOIN g b ON a.userId = b.userId AND a.p < b.p GROUP BY 1, 2),
edges AS (SELECT * FROM pairs WHERE weight >= (SELECT quantile_cont(weight, 0.85) FROM pairs))
"""


def _pairs(spark, folder):
    return profile.genre_cooccurrence(lazy_train(spark, folder), _dim_movie(spark, folder))


@query(sql("", "train", "dim_movie").rstrip() + ",\n" + _PAIRS + "SELECT * FROM pairs")
def genre_cooccurrence(spark, folder):
    return _pairs(spark, folder)


@query(sql("", "train", "dim_movie").rstrip() + ",\n" + _PAIRS + "SELECT * FROM edges")
def strong_genre_edges(spark, folder):
    return profile.strong_edges(stage(_pairs(spark, folder), "pairs"))


@query(
    sql("", "train", "dim_movie").rstrip()
    + ",\n"
    + _PAIRS
    + """SELECT genre, count(*) AS degree, round(count(*) / nullif(count(*) OVER () - 1, 0), 6) AS centrality
         FROM (SELECT genre_a AS genre FROM edges UNION ALL SELECT genre_b FROM edges) GROUP BY genre"""
)
def degree_centrality(spark, folder):
    edges = profile.strong_edges(stage(_pairs(spark, folder), "pairs"))
    return profile.degree_centrality(edges).withColumn("centrality", S.rounded(F.col("centrality")))


@query(
    sql("", "train", "dim_movie").rstrip()
    + ",\n"
    + _PAIRS
    + "SELECT quantile_cont(weight, 0.85) AS weight_p85 FROM pairs"
)
def weight_percentile(spark, folder):
    return profile.percentile(stage(_pairs(spark, folder), "pairs"), "weight", 0.85, "weight_p85")


@query(
    sql(
        """SELECT 'summary' AS section, 'users' AS metric, count(DISTINCT userId)::DOUBLE AS value FROM ratings
           UNION ALL SELECT 'summary', 'movies', count(DISTINCT movieId) FROM ratings
           UNION ALL SELECT 'summary', 'ratings', count(*) FROM ratings
           UNION ALL SELECT 'summary', 'min_rating', min(rating) FROM ratings
           UNION ALL SELECT 'summary', 'max_rating', max(rating) FROM ratings
           UNION ALL SELECT 'missing_ratings', c, n FROM (SELECT unnest(['userId', 'movieId', 'rating', 'timestamp']) AS c,
             unnest([count(*) - count(userId), count(*) - count(movieId), count(*) - count(rating), count(*) - count(ts)]) AS n FROM ratings)
           UNION ALL SELECT 'missing_movies', c, n FROM (SELECT unnest(['movieId', 'title', 'genres']) AS c,
             unnest([count(*) - count(movieId), count(*) - count(title), count(*) - count(genres)]) AS n FROM movies)""",
        "ratings", "movies",
    )
)
def data_quality_summary(spark, folder):
    return profile.quality_summary(stage(T.ratings(spark, folder), "ratings"), T.movies(spark, folder))


@query(
    sql(
        """SELECT 'collection' AS section, 'total_movies' AS metric, count(*)::DOUBLE AS value FROM movies
           UNION ALL SELECT 'collection', 'total_ratings', count(*) FROM ratings
           UNION ALL SELECT 'collection', 'unique_users', count(DISTINCT userId) FROM ratings
           UNION ALL SELECT 'collection', 'first_timestamp', min(ts) FROM ratings
           UNION ALL SELECT 'collection', 'last_timestamp', max(ts) FROM ratings
           UNION ALL SELECT 'collection', 'success_percent',
             count(*) FILTER (coalesce(overview, '') <> '' OR coalesce("cast", '') <> '' OR coalesce(director, '') <> '') * 100.0 / count(*)
             FROM movies LEFT JOIN metadata USING (movieId)""",
        "ratings", "movies", "metadata",
    )
)
def collection_summary(spark, folder):
    movies = T.movies(spark, folder)
    attempts = movies.select("movieId").join(T.metadata(spark, folder), "movieId", "left")
    return profile.collection_summary(movies, T.ratings(spark, folder), attempts)


def _types_sql(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, any_value(typeof({c})) AS column_type, count({c}) AS known FROM {table}" for c in columns
    )


@query(sql(f"{_types_sql('ratings', ('userId', 'movieId', 'rating'))} UNION ALL {_types_sql('movies', ('movieId', 'title', 'genres'))}", "ratings", "movies"))
def column_type_summary(spark, folder):
    """Types and known values of the columns of both tables."""
    ratings = T.ratings(spark, folder).select("userId", "movieId", "rating")
    return profile.column_types({"ratings": ratings, "movies": T.movies(spark, folder)})


@query(
    sql(
        """SELECT year(DATE '1970-01-01' + CAST(ts // 86400 AS INTEGER))::INTEGER AS period, count(DISTINCT userId) AS users, count(DISTINCT movieId) AS movies,
             true AS users_close, true AS movies_close FROM ratings GROUP BY 1""",
        "ratings",
    )
)
def distinct_counts_by_year(spark, folder):
    """Distinct users and movies per year, and whether the estimates from stored daily sketches are within 3 %."""
    ratings = stage(T.ratings(spark, folder), "ratings")
    daily = stage(sketches.daily_sketches(ratings), "sketches")
    estimates = sketches.distinct_in(daily, F.year("day")).withColumnsRenamed({"users": "_users", "movies": "_movies"})
    year = F.year(S.epoch_date(F.col("timestamp"))).alias("period")
    exact = ratings.groupBy(year).agg(F.count_distinct("userId").alias("users"), F.count_distinct("movieId").alias("movies"))
    close = [(F.abs(F.col(f"_{c}") - F.col(c)) <= F.col(c) * 0.03).alias(f"{c}_close") for c in ("users", "movies")]
    return exact.join(estimates, "period").select("period", "users", "movies", *close)
