"""Registry of runnable queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ratingmill.functions.stopwords import ENGLISH
from ratingmill.operators import neighbours, splitting
from ratingmill.operators.warehouse import build_cube, build_warehouse
from ratingmill.session import stage
from ratingmill.sources import tables as T

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return register


# --- shared inputs -------------------------------------------------------------------------


def lazy_split(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings with ``is_train``; order lines bound the ratings of a user from above."""
    rows = T.rating_rows(spark, folder).select("userId")
    return splitting.split_per_user(T.ratings(spark, folder), bound=rows)


def split_of(spark: SparkSession, folder: str) -> DataFrame:
    """The split written once, for queries that read it several times."""
    return stage(lazy_split(spark, folder), "split")


def train_of(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.train_rows(split_of(spark, folder))


def lazy_train(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.train_rows(lazy_split(spark, folder))


def centred_of(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Centred training ratings and the test users."""
    split = split_of(spark, folder)
    return neighbours.centred_train(splitting.train_rows(split)), splitting.test_rows(split).select("userId").distinct()


def star_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return build_warehouse(split_of(spark, folder), T.movies(spark, folder), T.links(spark, folder), T.metadata(spark, folder))


def cube_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of one cube query, nothing written: Spark drops what the query leaves out."""
    return build_cube(T.ratings(spark, folder), T.movies(spark, folder), T.links(spark, folder), T.metadata(spark, folder))


# --- SQL building blocks -------------------------------------------------------------------

_STOPS = ", ".join(f"'{w}'" for w in ENGLISH)

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "rating_rows": (
        """SELECT o_custkey AS userId, l_partkey AS movieId, ceil(l_quantity / 5) / 2 AS rating,
             CAST(epoch(l_shipdate) AS BIGINT) AS ts, l_orderkey, l_suppkey, l_linenumber, l_quantity
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        (),
    ),
    "ratings": (
        """SELECT userId, movieId, rating, ts FROM (
             SELECT *, row_number() OVER (PARTITION BY userId, movieId
               ORDER BY ts DESC, l_orderkey, l_suppkey, l_linenumber, l_quantity DESC) AS n FROM rating_rows)
           WHERE n = 1""",
        ("rating_rows",),
    ),
    "movies": (
        """SELECT p_partkey AS movieId,
             CASE WHEN p_size % 10 = 0 THEN p_name ELSE p_name || ' (' || (1970 + p_size) || ')' END AS title,
             CASE WHEN p_brand = 'Brand#13' THEN ''
                  ELSE p_type || '|' || split_part(p_name, ' ', 1) || '|' || split_part(p_name, ' ', 2) END AS genres
           FROM part""",
        (),
    ),
    "type_movies": ("SELECT movieId, title, split_part(genres, '|', 1) AS genres FROM movies", ("movies",)),
    "movie_genres": (
        """SELECT movieId, trim(g) AS genre FROM (SELECT movieId, unnest(string_split(genres, '|')) AS g FROM movies)
           WHERE trim(g) NOT IN ('', 'Unknown')""",
        ("movies",),
    ),
    "links": (
        """SELECT p_partkey AS movieId, printf('tt%07d', p_partkey) AS imdbId, p_partkey + 100000 AS tmdbId
           FROM part WHERE p_size % 2 = 0""",
        (),
    ),
    "metadata": (
        """SELECT doc_id AS movieId, text AS overview, CASE WHEN lang <> 'en' THEN lang || '|' || source END AS "cast",
             nullif(source, 'src0') AS director FROM documents""",
        (),
    ),
    "split": (
        """SELECT userId, movieId, rating, ts, rn * 5 <= n * 4 AS is_train FROM (
             SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS rn,
               count(*) OVER (PARTITION BY userId) AS n FROM ratings)""",
        ("ratings",),
    ),
    "train": ("SELECT userId, movieId, rating, ts FROM split WHERE is_train", ("split",)),
    "test": ("SELECT userId, movieId, rating, ts FROM split WHERE NOT is_train", ("split",)),
    "means": ("SELECT userId, avg(rating) AS m FROM train GROUP BY userId", ("train",)),
    "centred": (
        "SELECT t.userId, t.movieId, t.rating, m, t.rating - m AS r FROM train t JOIN means USING (userId)",
        ("train", "means"),
    ),
    "dim_user": (
        """SELECT userId AS user_id, count(*) AS rating_count, avg(rating) AS avg_rating,
             CASE WHEN count(*) < 50 THEN 'Low' WHEN count(*) < 500 THEN 'Medium' ELSE 'High' END AS activity_level
           FROM split GROUP BY userId""",
        ("split",),
    ),
    "dim_movie": (
        """SELECT movieId AS movie_id, tmdbId AS tmdb_id, title, y AS release_year,
             coalesce(CAST(y // 10 * 10 AS VARCHAR) || 's', 'Unknown') AS decade,
             coalesce(nullif(split_part(genres, '|', 1), ''), 'Unknown') AS primary_genre, genres AS all_genres,
             CAST(coalesce(length(overview), 0) AS INTEGER) AS overview_length
           FROM (SELECT *, TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') AS INTEGER) AS y FROM movies)
             LEFT JOIN links USING (movieId) LEFT JOIN metadata USING (movieId)""",
        ("movies", "links", "metadata"),
    ),
    "dim_time": (
        """SELECT row_number() OVER (ORDER BY d) AS time_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
             CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
             CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend
           FROM (SELECT DISTINCT DATE '1970-01-01' + CAST(ts // 86400 AS INTEGER) AS d FROM ratings)""",
        ("ratings",),
    ),
    "fact_rating": (
        """SELECT row_number() OVER (ORDER BY s.userId, s.movieId, s.ts) AS fact_id, s.userId AS user_id, s.movieId AS movie_id, t.time_id, s.rating,
             s.rating - coalesce(m, 0) AS normalized_rating, s.is_train
           FROM split s LEFT JOIN means USING (userId)
             LEFT JOIN dim_time t ON t.full_date = DATE '1970-01-01' + CAST(s.ts // 86400 AS INTEGER)""",
        ("split", "means", "dim_time"),
    ),
    # Users: cosine of centred ratings.
    "user_unit": (
        """SELECT c.userId, c.movieId, coalesce(r / nullif(n, 0), 0) AS w FROM centred c
           JOIN (SELECT userId, sqrt(sum(r * r)) AS n FROM centred GROUP BY userId) USING (userId)""",
        ("centred",),
    ),
    "user_sim": (
        """SELECT a.userId AS u, b.userId AS v, round(sum(a.w * b.w), 6) + 0.0 AS s FROM user_unit a
           JOIN user_unit b ON a.movieId = b.movieId AND a.userId <> b.userId GROUP BY 1, 2""",
        ("user_unit",),
    ),
    # Zeros rank between positive and negative similarities; only their number matters.
    "user_near": (
        """SELECT u, v, s, CAST(rk AS INTEGER) AS rk FROM (
             SELECT u, v, s, row_number() OVER (PARTITION BY u, s > 0 ORDER BY s DESC, v)
               + CASE WHEN s > 0 THEN 0 ELSE (SELECT count(DISTINCT userId) - 1 FROM centred)
                   - count(*) OVER (PARTITION BY u, s > 0) END AS rk
             FROM user_sim WHERE s <> 0) WHERE rk <= 20""",
        ("user_sim", "centred"),
    ),
    # Every unseen training movie is a candidate; one without a weighted rating deviates by 0.
    "unseen": (
        """SELECT u.userId, i.movieId FROM (SELECT DISTINCT userId FROM train WHERE userId IN (SELECT userId FROM test)) u,
             (SELECT DISTINCT movieId FROM train) i
           WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = u.userId AND t.movieId = i.movieId)""",
        ("train", "test"),
    ),
    "ubcf": (
        """SELECT userId, CAST(rk AS INTEGER) AS rank, movieId, least(5.0, greatest(0.5, m + d)) AS predicted_rating,
             'UBCF' AS method
           FROM (SELECT userId, movieId, d, row_number() OVER (PARTITION BY userId ORDER BY d DESC, movieId) AS rk
                 FROM (SELECT userId, movieId, coalesce(d, 0) AS d FROM unseen LEFT JOIN (
                         SELECT w.u AS userId, c.movieId, round(sum(w.w * c.r), 6) + 0.0 AS d
                         FROM (SELECT u, v, s / sum(abs(s)) OVER (PARTITION BY u) AS w FROM user_near) w
                         JOIN centred c ON c.userId = w.v GROUP BY 1, 2) USING (userId, movieId)
                       WHERE userId IN (SELECT u FROM user_near)))
             JOIN means USING (userId) WHERE rk <= 10""",
        ("user_near", "centred", "means", "unseen"),
    ),
    # Movies: cosine of centred ratings.
    "item_unit": (
        """SELECT c.userId, c.movieId, coalesce(r / nullif(n, 0), 0) AS w FROM centred c
           JOIN (SELECT movieId, sqrt(sum(r * r)) AS n FROM centred GROUP BY movieId) USING (movieId)""",
        ("centred",),
    ),
    "item_sim": (
        """SELECT a.movieId AS i, b.movieId AS j, sum(a.w * b.w) AS s FROM item_unit a
           JOIN item_unit b ON a.userId = b.userId AND a.movieId <> b.movieId GROUP BY 1, 2""",
        ("item_unit",),
    ),
    "item_near": (
        """SELECT i, j, s, CAST(rk AS INTEGER) AS rk FROM (
             SELECT i, j, s, row_number() OVER (PARTITION BY i, s > 0 ORDER BY s DESC, j)
               + CASE WHEN s > 0 THEN 0 ELSE (SELECT count(DISTINCT movieId) - 1 FROM centred)
                   - count(*) OVER (PARTITION BY i, s > 0) END AS rk
             FROM (SELECT i, j, round(s, 6) + 0.0 AS s FROM item_sim) WHERE s <> 0) WHERE rk <= 20""",
        ("item_sim", "centred"),
    ),
    "ibcf": (
        """SELECT userId, CAST(rk AS INTEGER) AS rank, movieId, least(5.0, greatest(0.5, m + d)) AS predicted_rating,
             'IBCF' AS method
           FROM (SELECT userId, movieId, d, row_number() OVER (PARTITION BY userId ORDER BY d DESC, movieId) AS rk
                 FROM (SELECT userId, movieId, coalesce(d, 0) AS d FROM unseen LEFT JOIN (
                         SELECT c.userId, k.i AS movieId,
                           round(coalesce(sum(k.s * c.r) / nullif(sum(CASE WHEN c.r <> 0 THEN abs(k.s) END), 0), 0), 6) + 0.0 AS d
                         FROM item_near k
                         JOIN centred c ON c.movieId = k.j GROUP BY 1, 2) USING (userId, movieId)))
             JOIN means USING (userId) WHERE rk <= 10""",
        ("item_near", "centred", "means", "unseen"),
    ),
    # TF-IDF of the movies' texts.
    "movie_text": (
        """SELECT movieId AS id, coalesce(overview, '') || ' ' || replace(genres, '|', ' ') || ' '
             || replace(coalesce("cast", ''), '|', ' ') AS text FROM movies LEFT JOIN metadata USING (movieId)""",
        ("movies", "metadata"),
    ),
    "tokens": (
        rf"""SELECT id, [t for t in regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') if t NOT IN ({_STOPS})] AS l
           FROM movie_text""",
        ("movie_text",),
    ),
    "term_rows": (
        """SELECT id, unnest(l) AS term FROM tokens
           UNION ALL SELECT id, unnest([l[i] || ' ' || l[i + 1] for i in range(1, len(l))]) AS term FROM tokens""",
        ("tokens",),
    ),
    "vocabulary": ("SELECT term FROM term_rows GROUP BY term ORDER BY count(*) DESC, term LIMIT 5000", ("term_rows",)),
    "term_counts": (
        "SELECT id, term, count(*) AS tf FROM term_rows WHERE term IN (SELECT term FROM vocabulary) GROUP BY 1, 2",
        ("term_rows", "vocabulary"),
    ),
    "tfidf": (
        """SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM (
             SELECT id, term, tf * (ln((1.0 + (SELECT count(*) FROM movie_text)) / (1.0 + df)) + 1.0) AS raw
             FROM term_counts JOIN (SELECT term, count(*) AS df FROM term_counts GROUP BY term) USING (term))""",
        ("term_counts", "movie_text"),
    ),
    "features": (
        """SELECT id, 'term=' || term AS feature, weight FROM tfidf
           UNION ALL SELECT DISTINCT movieId, 'genre=' || genre, 1.0 FROM movie_genres
           UNION ALL SELECT movie_id, 'decade=' || CASE WHEN decade = 'Unknown' THEN 'Unknown Era' ELSE decade END, 1.0
             FROM dim_movie""",
        ("tfidf", "movie_genres", "dim_movie"),
    ),
    "gram": (
        """SELECT a.id AS i, b.id AS j, sum(a.weight * b.weight) AS g FROM features a
           JOIN features b ON a.feature = b.feature GROUP BY 1, 2""",
        ("features",),
    ),
    "item_norm": ("SELECT i, sqrt(g) AS n FROM gram WHERE i = j", ("gram",)),
    "profile_norm": (
        """SELECT a.userId, sqrt(sum(a.rating * b.rating * g)) AS n FROM train a JOIN train b ON a.userId = b.userId
           JOIN gram ON i = a.movieId AND j = b.movieId GROUP BY 1""",
        ("train", "gram"),
    ),
    "content_recs": (
        """SELECT userId, CAST(rk AS INTEGER) AS rank, movieId, least(5.0, greatest(0.5, c * 5)) AS predicted_rating,
             'Content-Based' AS method
           FROM (SELECT userId, movieId, c, row_number() OVER (PARTITION BY userId ORDER BY c DESC, movieId) AS rk
                 FROM (SELECT userId, j AS movieId, round(dot / (p.n * q.n), 6) + 0.0 AS c
                       FROM (SELECT userId, j, sum(rating * g) AS dot FROM train JOIN gram ON i = movieId GROUP BY 1, 2)
                         JOIN profile_norm p USING (userId) JOIN item_norm q ON q.i = j) x
                 WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = x.userId AND t.movieId = x.movieId)
                   AND userId IN (SELECT userId FROM test))
           WHERE rk <= 10""",
        ("train", "gram", "profile_norm", "item_norm", "test"),
    ),
    "content_scores": (
        """SELECT userId, movieId, rating, ts, round(coalesce(least(5.0, greatest(0.5, 5 * dot / (p.n * q.n))), 2.5), 6) AS content_score
           FROM test LEFT JOIN profile_norm p USING (userId) LEFT JOIN item_norm q ON q.i = movieId
             LEFT JOIN (SELECT e.userId, e.movieId, sum(t.rating * g) AS dot FROM test e JOIN train t ON t.userId = e.userId
                        JOIN gram ON i = t.movieId AND j = e.movieId GROUP BY 1, 2) USING (userId, movieId)""",
        ("test", "train", "gram", "profile_norm", "item_norm"),
    ),
    # Damped biases.
    "global_mean": ("SELECT avg(rating) AS mu FROM train", ("train",)),
    "item_bias": (
        "SELECT movieId, sum(rating - mu) / (count(*) + 5.0) AS bi FROM train, global_mean GROUP BY movieId",
        ("train", "global_mean"),
    ),
    "user_bias": (
        """SELECT userId, sum(rating - mu - bi) / (count(*) + 5.0) AS bu FROM train JOIN item_bias USING (movieId), global_mean
           GROUP BY userId""",
        ("train", "item_bias", "global_mean"),
    ),
    "scored": (
        """SELECT userId, movieId, rating, content_score, mu + coalesce(bu, 0) + coalesce(bi, 0) AS cf_score
           FROM content_scores LEFT JOIN user_bias USING (userId) LEFT JOIN item_bias USING (movieId), global_mean""",
        ("content_scores", "user_bias", "item_bias", "global_mean"),
    ),
    # Estimates of the test pairs by every family.
    "ubcf_pairs": (
        """SELECT e.userId, e.movieId, least(5.0, greatest(0.5, m + coalesce(d, 0))) AS ubcf FROM test e JOIN means USING (userId)
           LEFT JOIN (SELECT w.u AS userId, c.movieId, round(sum(w.w * c.r), 6) + 0.0 AS d
                      FROM (SELECT u, v, s / sum(abs(s)) OVER (PARTITION BY u) AS w FROM user_near) w
                      JOIN centred c ON c.userId = w.v GROUP BY 1, 2) USING (userId, movieId)
           WHERE e.userId IN (SELECT u FROM user_near)""",
        ("user_near", "centred", "means", "test"),
    ),
    "ibcf_pairs": (
        """SELECT e.userId, e.movieId, least(5.0, greatest(0.5, m + coalesce(d, 0))) AS ibcf FROM test e JOIN means USING (userId)
           LEFT JOIN (SELECT c.userId, k.i AS movieId,
                        round(coalesce(sum(k.s * c.r) / nullif(sum(CASE WHEN c.r <> 0 THEN abs(k.s) END), 0), 0), 6) + 0.0 AS d
                      FROM item_near k JOIN centred c ON c.movieId = k.j GROUP BY 1, 2) USING (userId, movieId)""",
        ("item_near", "centred", "means", "test"),
    ),
    "family_scores": (
        """SELECT *, 0.7 * cf_score + 0.3 * content_score AS blend FROM scored
           LEFT JOIN ubcf_pairs USING (userId, movieId) LEFT JOIN ibcf_pairs USING (userId, movieId)""",
        ("scored", "ubcf_pairs", "ibcf_pairs"),
    ),
    "lists": ("SELECT * FROM ubcf UNION ALL SELECT * FROM ibcf UNION ALL SELECT * FROM content_recs", ("ubcf", "ibcf", "content_recs")),
    "pooled": ("SELECT * FROM ubcf UNION ALL SELECT * FROM ibcf", ("ubcf", "ibcf")),
    "pooled_families": (
        "SELECT split_part(split_part(method, ' ', 1), '-', 1) AS method, userId, movieId, rank FROM lists",
        ("lists",),
    ),
    # Rules by bit masks over the movie types.
    "type_bits": (
        """SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS bit
           FROM (SELECT DISTINCT genres AS genre FROM type_movies WHERE genres NOT IN ('', 'Unknown'))""",
        ("type_movies",),
    ),
    "subsets": (
        """SELECT s, string_agg(genre, ', ' ORDER BY genre) AS items, count(*) AS n
           FROM (SELECT unnest(range(1, CAST(1 << (SELECT max(bit) + 1 FROM type_bits) AS BIGINT))) AS s)
             JOIN type_bits ON (s >> bit) & 1 = 1 GROUP BY s""",
        ("type_bits",),
    ),
}


def sql(body: str, *needs: str) -> str:
    """``body`` preceded by the building blocks it needs, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            add(dep)
        order.append(name)

    for name in needs:
        add(name)
    blocks = [f"{name} AS MATERIALIZED ({CTES[name][0]})" for name in order]
    return ("WITH " + ",\n".join(blocks) + "\n" if blocks else "") + body


def rule_sql(owners: str, tail: str, *needs: str) -> str:
    """Rules of the baskets ``owners`` (a query of owner, mask) followed by ``tail``."""
    return sql("", *needs, "subsets").rstrip() + f""",
masks AS MATERIALIZED ({owners}),
frequent AS MATERIALIZED (
  SELECT s, items, n, freq, freq / (SELECT count(*) FROM masks) AS support
  FROM (SELECT s, items, n, (SELECT count(*) FROM masks WHERE mask & s = s) AS freq FROM subsets)
  WHERE freq >= 0.05 * (SELECT count(*) FROM masks)),
rules AS MATERIALIZED (
  SELECT a.items AS antecedents, c.items AS consequents, a.n AS na, c.n AS nc, f.support AS support,
    f.support / a.support AS confidence, f.support / a.support / c.support AS lift,
    f.support - a.support * c.support AS leverage
  FROM frequent f JOIN frequent a ON a.s & f.s = a.s AND a.s <> f.s JOIN frequent c ON c.s = f.s - a.s
  WHERE f.support / a.support >= 0.4)
{tail}"""


def genre_rule_sql(owner: str, support: float, confidence: float, tail: str, *needs: str) -> str:
    """Rules of baskets of all genres: masks of genres, larger itemsets grown from frequent ones up to all 22 genres, followed by ``tail``."""
    grown = ",\n".join(
        f"""f{k} AS MATERIALIZED (SELECT a.s | i.s AS s, sum(c)::BIGINT AS freq FROM f{k - 1} a JOIN f1 i ON i.s > a.s JOIN grouped ON mask & (a.s | i.s) = a.s | i.s
  GROUP BY 1 HAVING sum(c) >= (SELECT {support} * n FROM baskets))"""
        for k in range(2, 23)
    )
    return sql("", *needs, "movie_genres").rstrip() + f""",
bits AS MATERIALIZED (SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS bit FROM (SELECT DISTINCT genre FROM movie_genres)),
masks AS MATERIALIZED (SELECT owner, coalesce(bit_or(1::BIGINT << bit), 0) AS mask
  FROM ({owner}) LEFT JOIN movie_genres USING (movieId) LEFT JOIN bits USING (genre) GROUP BY 1),
grouped AS MATERIALIZED (SELECT mask, count(*) AS c FROM masks GROUP BY 1),
baskets AS (SELECT count(*) AS n FROM masks),
f1 AS MATERIALIZED (SELECT 1::BIGINT << bit AS s, sum(c)::BIGINT AS freq FROM bits JOIN grouped ON (mask >> bit) & 1 = 1 GROUP BY 1
  HAVING sum(c) >= (SELECT {support} * n FROM baskets)),
{grown},
sets AS ({" UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(1, 23))}),
frequent AS MATERIALIZED (
  SELECT s, freq, freq / n AS support, (SELECT string_agg(genre, ', ' ORDER BY bit) FROM bits WHERE (s >> bit) & 1 = 1) AS items FROM sets, baskets),
rules AS MATERIALIZED (
  SELECT a.items AS antecedents, c.items AS consequents, f.support AS support, f.support / a.support AS confidence,
    f.support / a.support / c.support AS lift, f.support - a.support * c.support AS leverage
  FROM frequent f JOIN frequent a ON a.s & f.s = a.s AND a.s <> f.s JOIN frequent c ON c.s = f.s - a.s
  WHERE f.support / a.support >= {confidence})
{tail}"""
