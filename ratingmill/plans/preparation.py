"""Queries: sources, sinks, cleaning, splits and warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators import cleaning, olap, quality, splitting, warehouse
from ratingmill.plans.base import cube_of, lazy_split, lazy_train, query, split_of, sql, star_of
from ratingmill.session import fresh_path, stage
from ratingmill.sources import buckets, readers, schemas, sinks
from ratingmill.sources import tables as T


@query(sql('SELECT userId, movieId, rating, ts AS "timestamp" FROM ratings', "ratings"))
def ratings_first_per_key(spark, folder):
    return T.ratings(spark, folder)


@query(sql("SELECT userId, movieId, rating, title FROM ratings JOIN movies USING (movieId) WHERE rating >= 3.5", "ratings", "movies"))
def csv_scan(spark, folder):
    """Ratings and movies written as CSV, scanned with declared schemas, filtered and joined."""
    path = fresh_path(spark, "csv")
    sinks.write_csv(T.ratings(spark, folder), f"{path}/ratings")
    sinks.write_csv(T.movies(spark, folder), f"{path}/movies")
    ratings = readers.read_csv(spark, f"{path}/ratings", schemas.RATINGS)
    movies = readers.read_csv(spark, f"{path}/movies", schemas.MOVIES)
    return ratings.filter("rating >= 3.5").join(movies, "movieId").select("userId", "movieId", "rating", "title")


@query(
    sql(
        """SELECT movieId, imdbId, md5(overview) AS overview_md5, "cast", tags FROM links LEFT JOIN metadata USING (movieId)
           LEFT JOIN (SELECT l_partkey AS movieId, string_agg(DISTINCT l_returnflag || ', ' || l_linestatus, '|' ORDER BY l_returnflag || ', ' || l_linestatus) AS tags
                      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (movieId)""",
        "links", "metadata",
    )
)
def csv_scan_catalogue(spark, folder):
    """Links, tags and metadata, whose texts hold commas, quotes and line breaks, written as CSV and scanned with declared schemas."""
    path = fresh_path(spark, "csv")
    columns = [F.lit(None).cast("string").alias(c) for c in ("poster_url", "original_language")]
    sinks.write_csv(T.links(spark, folder), f"{path}/links")
    sinks.write_csv(T.tags(spark, folder), f"{path}/tags")
    sinks.write_csv(T.metadata(spark, folder).select("*", *columns), f"{path}/metadata")
    links = readers.read_csv(spark, f"{path}/links", schemas.LINKS)
    tags = readers.read_csv(spark, f"{path}/tags", schemas.TAGS)
    metadata = readers.read_csv(spark, f"{path}/metadata", schemas.METADATA, multi_line=True)
    # Two values at most: a tag is a flag and a status.
    named = tags.groupBy("movieId").agg(F.array_join(F.array_sort(F.collect_set("tag")), "|").alias("tags"))
    joined = links.join(metadata, "movieId", "left").join(named, "movieId", "left")
    return joined.select("movieId", "imdbId", F.md5("overview").alias("overview_md5"), "cast", "tags")


@query(sql("SELECT movieId, title, '' AS overview, 'Unknown' AS \"cast\", 'Unknown Director' AS director FROM movies", "movies"))
def optional_source(spark, folder):
    """An absent metadata file behaves as an empty table; its columns get their defaults."""
    absent = readers.read_optional_csv(spark, fresh_path(spark, "absent.csv"), schemas.METADATA)
    joined = T.movies(spark, folder).join(absent, "movieId", "left")
    return cleaning.fill_metadata(joined).select("movieId", "title", "overview", "cast", "director")


@query(
    sql(
        """SELECT movieId, md5(overview) AS overview_md5, "cast", director FROM metadata WHERE movieId % 2 = 0
           UNION ALL SELECT movieId, md5(overview), "cast", director FROM metadata WHERE movieId % 2 = 1""",
        "metadata",
    )
)
def append_sink(spark, folder):
    """Metadata written in two appended batches and read back."""
    path = fresh_path(spark, "appended")
    metadata = T.metadata(spark, folder)
    for rest in (0, 1):
        sinks.append_parquet(metadata.filter(F.col("movieId") % 2 == rest), path)
    return spark.read.parquet(path).select("movieId", F.md5("overview").alias("overview_md5"), "cast", "director")


@query(sql("SELECT CAST(rating AS VARCHAR) AS method, count(*)::DOUBLE AS value FROM ratings GROUP BY 1", "ratings"))
def json_sink(spark, folder):
    """Metric rows written as JSON and read back with a declared schema."""
    path = fresh_path(spark, "metrics")
    counts = T.ratings(spark, folder).groupBy(F.col("rating").cast("string").alias("method"))
    sinks.write_json(counts.agg(F.count("*").cast("double").alias("value")), path)
    return spark.read.schema("method string, value double").json(path)


@query(
    sql(
        """SELECT 'dim_user' AS table_name, count(*) AS row_count FROM dim_user
           UNION ALL SELECT 'dim_movie', count(*) FROM dim_movie
           UNION ALL SELECT 'dim_genre', count(*) FROM (SELECT DISTINCT trim(unnest(string_split(genres, '|'))) AS g FROM movies) WHERE g <> ''
           UNION ALL SELECT 'dim_time', count(*) FROM dim_time
           UNION ALL SELECT 'fact_rating', count(*) FROM fact_rating""",
        "dim_user", "dim_movie", "dim_time", "fact_rating",
    )
)
def warehouse_tables(spark, folder):
    """Five tables dropped, recreated and read back; rows of each."""
    path = fresh_path(spark, "warehouse")
    sinks.write_tables(star_of(spark, folder), path)
    return quality.table_counts(sinks.read_tables(spark, warehouse.TABLES, path))


@query(
    sql(
        """SELECT movieId, 'zz ' || title AS title, genres FROM movies WHERE movieId % 6 = 0
           UNION ALL SELECT movieId, title, genres FROM movies WHERE movieId % 6 = 3
           UNION ALL SELECT movieId, 'old ' || title, genres FROM movies WHERE movieId % 3 = 1""",
        "movies",
    )
)
def upsert_by_key(spark, folder):
    """Rows with known keys are replaced, others added; of two updates of a movie one counts."""
    movies = T.movies(spark, folder)
    target = movies.filter("movieId % 3 <> 2").withColumn("title", F.concat(F.lit("old "), "title"))
    again = movies.filter("movieId % 6 = 0").withColumn("title", F.concat(F.lit("zz "), "title"))
    return sinks.upsert(target, movies.filter("movieId % 3 = 0").unionByName(again), ["movieId"])


@query(
    sql(
        """SELECT userId, movieId, CASE WHEN movieId % 100 = 7 THEN 5.0 WHEN movieId % 100 = 8 THEN 0.5 ELSE rating END AS rating
           FROM ratings WHERE movieId % 100 <> 8 OR userId % 2 = 0""",
        "ratings",
    )
)
def incremental_upsert(spark, folder):
    """A bucketed table of ratings after a small upsert and after missing rows were added."""
    rows = stage(T.ratings(spark, folder).select("userId", "movieId", "rating"), "ratings")
    kind = F.col("movieId") % 100
    table = buckets.BucketTable(spark, fresh_path(spark, "bucketed"))
    table.create(rows.filter(kind != 8), ["userId", "movieId"], 32)
    table.upsert(rows.filter(kind == 7).withColumn("rating", F.lit(5.0)))
    late = rows.filter((kind == 7) | ((kind == 8) & (F.col("userId") % 2 == 0)))
    table.add_missing(late.withColumn("rating", F.lit(0.5)))
    return table.read()


_PAYLOAD_SQL = """
SELECT doc_id AS movieId, md5(text) AS overview_md5,
  array_to_string(string_split(text, ' ')[1:5], '{sep}') AS "cast",
  CASE WHEN source = 'src0' THEN '{none}' ELSE source END AS director,
  CASE WHEN lang = 'en' THEN '' ELSE 'https://image.tmdb.org/t/p/w500/' || source || '.jpg' END AS poster_url,
  lang AS original_language
FROM documents"""


def _payload_fields(spark, folder, **variant):
    fields = readers.payload_metadata(T.payloads(spark, folder), **variant)
    return fields.withColumn("overview_md5", F.md5("overview")).drop("overview")


@query(_PAYLOAD_SQL.format(sep="|", none="Unknown"))
def payload_fields(spark, folder):
    return _payload_fields(spark, folder)


@query(_PAYLOAD_SQL.format(sep=" ", none=""))
def payload_fields_spaced(spark, folder):
    return _payload_fields(spark, folder, cast_separator=" ", no_director="")


@query(
    """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type, count(*) AS n
       FROM events GROUP BY 1, 2"""
)
def json_column(spark, folder):
    """A flat JSON column parsed with a declared schema."""
    parsed = T.table(spark, folder, "events").select("event_type", F.from_json("props", "k int").alias("p"))
    return parsed.groupBy(F.col("p.k").alias("k"), "event_type").agg(F.count("*").alias("n"))


@query(
    sql(
        """SELECT movieId, tmdbId, title, genres,
             TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') AS INTEGER) AS release_year,
             md5(overview) AS overview_md5, "cast", director
           FROM movies LEFT JOIN links USING (movieId) LEFT JOIN metadata USING (movieId)""",
        "movies", "links", "metadata",
    )
)
def raw_movies(spark, folder):
    rows = cleaning.raw_movies(T.movies(spark, folder), T.links(spark, folder), T.metadata(spark, folder))
    return rows.withColumn("overview_md5", F.md5("overview")).drop("overview")


@query(
    sql(
        """SELECT movieId, md5(overview) AS overview_md5, "cast", director FROM metadata
           UNION ALL SELECT movieId, md5('Great movie overview.'), 'Actor A Actor B', 'Director X' FROM links
             WHERE movieId NOT IN (SELECT movieId FROM metadata)""",
        "metadata", "links",
    )
)
def filled_metadata(spark, folder):
    rows = cleaning.complete_metadata(T.links(spark, folder), T.metadata(spark, folder))
    return rows.withColumn("overview_md5", F.md5("overview")).drop("overview")


@query(sql("SELECT movieId FROM movies WHERE movieId NOT IN (SELECT movieId FROM metadata)", "movies", "metadata"))
def missing_metadata(spark, folder):
    return cleaning.missing_metadata(T.movies(spark, folder), T.metadata(spark, folder))


@query(
    sql(
        """SELECT movieId, coalesce("cast", 'Unknown') AS "cast", coalesce(director, 'Unknown Director') AS director
           FROM metadata""",
        "metadata",
    )
)
def metadata_defaults(spark, folder):
    return cleaning.fill_metadata(T.metadata(spark, folder)).select("movieId", "cast", "director")


@query(
    """SELECT o_orderkey, o_totalprice AS price,
         TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN split_part(o_orderpriority, '-', 1) ELSE o_orderpriority END AS DOUBLE) AS priority_number
       FROM orders"""
)
def numeric_coercion(spark, folder):
    """Prices printed with thousands commas read back as numbers; text that is none gives null."""
    orders = T.table(spark, folder, "orders")
    printed = orders.select("o_orderkey", F.format_number("o_totalprice", 2).alias("printed"), "o_orderpriority")
    return printed.select(
        "o_orderkey",
        S.strip_commas(F.col("printed")).alias("price"),
        F.when(F.col("o_orderkey") % 3 == 0, F.split_part("o_orderpriority", F.lit("-"), F.lit(1)))
        .otherwise(F.col("o_orderpriority"))
        .try_cast("double")
        .alias("priority_number"),
    )


@query("SELECT DISTINCT o_custkey AS userId, l_partkey AS movieId, ceil(l_quantity / 5) / 2 AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def exact_duplicates_dropped(spark, folder):
    return T.rating_rows(spark, folder).select("userId", "movieId", "rating").dropDuplicates()


_USERS_FIRST = """u AS (SELECT * FROM ratings WHERE userId IN (SELECT userId FROM ratings GROUP BY 1 HAVING count(*) >= {u})),
kept AS (SELECT * FROM u WHERE movieId IN (SELECT movieId FROM u GROUP BY 1 HAVING count(*) >= {m}))"""
_MOVIES_FIRST = """u AS (SELECT * FROM ratings WHERE movieId IN (SELECT movieId FROM ratings GROUP BY 1 HAVING count(*) >= {m})),
kept AS (SELECT * FROM u WHERE userId IN (SELECT userId FROM u GROUP BY 1 HAVING count(*) >= {u}))"""


def _filter_sql(order, tail, *needs, u=35, m=25):
    return sql("", "ratings", *needs).rstrip() + ",\n" + order.format(u=u, m=m) + "\n" + tail


@query(_filter_sql(_USERS_FIRST, "SELECT userId, movieId, rating FROM kept"))
def filter_users_first(spark, folder):
    ratings = stage(T.ratings(spark, folder), "ratings")
    return cleaning.filter_users_first(ratings, 35, 25).select("userId", "movieId", "rating")


@query(_filter_sql(_MOVIES_FIRST, "SELECT userId, movieId, rating FROM kept"))
def filter_movies_first(spark, folder):
    ratings = stage(T.ratings(spark, folder), "ratings")
    return cleaning.filter_movies_first(ratings, 35, 25).select("userId", "movieId", "rating")


@query(_filter_sql(_USERS_FIRST, "SELECT movieId, title FROM movies WHERE movieId IN (SELECT movieId FROM kept)", "movies"))
def movies_after_filter(spark, folder):
    kept = cleaning.filter_users_first(stage(T.ratings(spark, folder), "ratings"), 35, 25)
    return cleaning.sync_movies(T.movies(spark, folder), kept).select("movieId", "title")


@query(
    _filter_sql(
        _MOVIES_FIRST,
        """SELECT (SELECT count(DISTINCT userId) FROM ratings) - count(DISTINCT userId) AS dropped_users,
             (SELECT count(DISTINCT movieId) FROM ratings) - count(DISTINCT movieId) AS dropped_movies FROM kept""",
    )
)
def filter_drop_counts(spark, folder):
    ratings = stage(T.ratings(spark, folder), "ratings")
    return cleaning.drop_counts(ratings, cleaning.filter_movies_first(ratings, 35, 25))


@query(sql("SELECT DISTINCT userId FROM ratings", "ratings"))
def distinct_users(spark, folder):
    return T.ratings(spark, folder).select("userId").distinct()


@query(
    sql(
        """SELECT movie_id AS movieId, title, release_year, decade, string_agg(genre, ', ' ORDER BY genre) AS genres
           FROM dim_movie LEFT JOIN movie_genres ON movieId = movie_id GROUP BY ALL""",
        "dim_movie", "movie_genres",
    )
)
def cleaned_movies(spark, folder):
    rows = cleaning.clean_movies(T.movies(spark, folder))
    listed = F.nullif(F.array_join(F.array_sort("genre_list"), ", "), F.lit(""))
    return rows.select("movieId", "title", "release_year", "decade", listed.alias("genres"))


@query(
    sql(
        """SELECT movieId, CASE WHEN genre = 'PROMO' THEN 'PROMO''s "best"' ELSE genre END AS genre FROM movie_genres""",
        "movie_genres",
    )
)
def legacy_genre_lists(spark, folder):
    """Genre lists printed as ``['A', "B's"]`` parsed back to arrays."""
    movies = T.movies(spark, folder)
    odd = F.lit("\"PROMO's \\\"best\\\"\"")
    quoted = F.transform(F.split("genres", r"\|"), lambda g: F.when(g == "PROMO", odd).otherwise(F.concat(F.lit("'"), g, F.lit("'"))))
    printed = movies.select("movieId", F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]")).alias("printed"))
    names = printed.select("movieId", F.explode(S.parse_list_text(F.col("printed"))).alias("genre"))
    return names.filter("genre <> ''")


@query(
    sql(
        """SELECT movieId, title FROM movies WHERE regexp_matches(title, '(?i)^[a-z]+ (RING|widget).*19[89]')
           ORDER BY movieId LIMIT 50""",
        "movies",
    )
)
def title_search(spark, folder):
    return cleaning.search_titles(T.movies(spark, folder), "^[a-z]+ (RING|widget).*19[89]").select("movieId", "title")


@query(sql('SELECT userId, movieId, rating, ts AS "timestamp", is_train FROM split', "split"))
def split_per_user(spark, folder):
    return lazy_split(spark, folder)


@query(
    sql(
        """SELECT userId, movieId, rn <= (SELECT count(*) * 4 // 5 FROM ratings) AS is_train
           FROM (SELECT *, row_number() OVER (ORDER BY ts, userId, movieId) AS rn FROM ratings)""",
        "ratings",
    )
)
def split_global(spark, folder):
    return splitting.split_global(T.ratings(spark, folder)).select("userId", "movieId", "is_train")


@query(
    sql(
        """SELECT userId, movieId, is_train, m AS user_mean_rating, rating - m AS normalized_rating
           FROM (SELECT *, avg(rating) FILTER (is_train) OVER (PARTITION BY userId) AS m FROM split)""",
        "split",
    )
)
def mean_centred(spark, folder):
    split = split_of(spark, folder)
    rows = splitting.centre(split, splitting.user_means(splitting.train_rows(split)))
    return rows.select("userId", "movieId", "is_train", "user_mean_rating", "normalized_rating")


@query(sql("SELECT * FROM dim_user", "dim_user"))
def dim_user(spark, folder):
    return warehouse.dim_user(lazy_split(spark, folder)).drop("user_index")


@query(
    sql(
        """SELECT userId AS user_id, count(*) AS rating_count, avg(rating) AS avg_rating,
             CASE WHEN count(*) < 50 THEN 'Low' WHEN count(*) < 500 THEN 'Medium' ELSE 'High' END AS activity_level
           FROM train GROUP BY userId""",
        "train",
    )
)
def dim_user_train_scope(spark, folder):
    return warehouse.dim_user(lazy_split(spark, folder), scope="train").drop("user_index")


@query(sql("SELECT * FROM dim_movie", "dim_movie"))
def dim_movie(spark, folder):
    return warehouse.dim_movie(T.movies(spark, folder), T.links(spark, folder), T.metadata(spark, folder))


@query(
    sql(
        """SELECT row_number() OVER (ORDER BY g) AS genre_id, g AS genre_name
           FROM (SELECT DISTINCT trim(unnest(string_split(genres, '|'))) AS g FROM movies) WHERE g <> ''""",
        "movies",
    )
)
def dim_genre(spark, folder):
    return warehouse.dim_genre(T.movies(spark, folder))


@query(sql("SELECT time_id, CAST(full_date AS VARCHAR) AS full_date, year, month, quarter, day_of_week, is_weekend FROM dim_time", "dim_time"))
def dim_time(spark, folder):
    return warehouse.dim_time(T.ratings(spark, folder)).withColumn("full_date", F.col("full_date").cast("string"))


@query(sql("SELECT * FROM fact_rating", "fact_rating"))
def fact_rating(spark, folder):
    split = split_of(spark, folder)
    return warehouse.fact_rating(split, warehouse.dim_time(split))


@query(sql("SELECT count(*) AS row_count, count(*) - count(rating) AS null_ratings FROM train", "train"))
def train_contract(spark, folder):
    return quality.train_contract(lazy_train(spark, folder))


@query(
    sql(
        """SELECT 'user_id' AS foreign_key, count(*) AS orphans FROM fact_rating WHERE user_id NOT IN (SELECT user_id FROM dim_user)
           UNION ALL SELECT 'movie_id', count(*) FROM fact_rating WHERE movie_id NOT IN (SELECT movie_id FROM dim_movie)
           UNION ALL SELECT 'time_id', count(*) FROM fact_rating WHERE time_id NOT IN (SELECT time_id FROM dim_time)""",
        "fact_rating", "dim_user", "dim_movie", "dim_time",
    )
)
def foreign_key_orphans(spark, folder):
    star = star_of(spark, folder)
    star["fact_rating"] = stage(star["fact_rating"], "fact")
    return quality.orphan_counts(star)


# --- OLAP ----------------------------------------------------------------------------------

_ROLLUP = """SELECT primary_genre, decade, round(avg(rating), 2) AS avg_rating, count(*) AS rating_count
FROM fact_rating JOIN dim_movie USING (movie_id) WHERE primary_genre <> 'Unknown' GROUP BY 1, 2"""
_DECADES = ("1970s", "1980s", "1990s", "2000s", "2010s", "Unknown")


@query(sql(_ROLLUP, "fact_rating", "dim_movie"))
def olap_rollup(spark, folder):
    return olap.rollup(cube_of(spark, folder))


@query(sql("SELECT round(avg(rating), 2) AS avg_rating FROM fact_rating", "fact_rating"))
def olap_overall_average(spark, folder):
    return olap.overall_average(cube_of(spark, folder))


@query(sql("SELECT round(avg(rating), 2) AS avg_rating FROM fact_rating JOIN dim_movie USING (movie_id) WHERE primary_genre = 'PROMO'", "fact_rating", "dim_movie"))
def olap_genre_average(spark, folder):
    return olap.genre_average(cube_of(spark, folder), "PROMO")


@query(
    sql(
        """SELECT title, round(avg(rating), 2) AS movie_avg, count(*) AS total_ratings
           FROM fact_rating JOIN dim_movie USING (movie_id) WHERE primary_genre = 'PROMO'
           GROUP BY title HAVING count(*) >= 50 ORDER BY movie_avg DESC, title LIMIT 10""",
        "fact_rating", "dim_movie",
    )
)
def olap_drilldown(spark, folder):
    return olap.drilldown(cube_of(spark, folder), "PROMO")


@query(
    sql(
        """SELECT title, year, rating, activity_level FROM fact_rating JOIN dim_movie USING (movie_id)
             JOIN dim_time USING (time_id) JOIN dim_user USING (user_id)
           WHERE primary_genre = 'SMALL' ORDER BY rating DESC, year, title, user_id, movie_id LIMIT 15""",
        "fact_rating", "dim_movie", "dim_time", "dim_user",
    )
)
def olap_slice(spark, folder):
    return olap.slice_genre(cube_of(spark, folder), "SMALL")


@query(
    sql(
        """SELECT title, primary_genre, release_year, count(*) AS popularity_count
           FROM fact_rating JOIN dim_movie USING (movie_id)
           WHERE primary_genre IN ('SMALL', 'PROMO') AND release_year > 2000 AND rating > 4.0
           GROUP BY 1, 2, 3 ORDER BY popularity_count DESC, title, primary_genre, release_year LIMIT 20""",
        "fact_rating", "dim_movie",
    )
)
def olap_dice(spark, folder):
    return olap.dice(cube_of(spark, folder), ["SMALL", "PROMO"])


@query(
    sql("", "fact_rating", "dim_movie").rstrip()
    + f",\nr AS ({_ROLLUP})\nSELECT primary_genre, "
    + ", ".join(f"max(CASE WHEN decade = '{d}' THEN avg_rating END) AS \"{d}\"" for d in _DECADES)
    + " FROM r GROUP BY primary_genre"
)
def olap_pivot(spark, folder):
    return olap.pivot(olap.rollup(cube_of(spark, folder)), _DECADES)
