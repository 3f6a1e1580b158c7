"""Item features, user profiles and content-based recommendations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.functions.stopwords import ENGLISH
from ratingmill.operators.blocked import BlockPlan, unit_short_rows
from ratingmill.operators.cleaning import first_per_key, search_titles
from ratingmill.operators.mips import nearest_vectors, top_products
from ratingmill.operators.neighbours import seen_pairs
from ratingmill.operators.text import tfidf
from ratingmill.operators.vectors import dense, packed, packed_units, pair_products, weighted_means, weighted_sums
from ratingmill.params import DEFAULTS
from ratingmill.session import stage, stage_alone

_ROUND_SALT = 7
NEUTRAL_SCORE = 2.5  # fixed value for a pair without profile or features


def combined_text(movies: DataFrame, metadata: DataFrame) -> DataFrame:
    """Overview, genres and cast of a movie as one text."""

    def spaced(name: str):
        return F.translate(F.coalesce(name, F.lit("")), "|", " ")

    # Shuffled, never broadcast: the texts are the large side, and the work on them is spread.
    texts = first_per_key(metadata.select("movieId", "overview", "cast"), ["movieId"]).hint("merge")
    joined = movies.join(texts, "movieId", "left")
    text = F.concat_ws(" ", F.coalesce("overview", F.lit("")), spaced("genres"), spaced("cast"))
    return joined.select(F.col("movieId").alias("id"), text.alias("text"))


def genre_one_hot(movies: DataFrame) -> DataFrame:
    """1.0 per movie and genre; equal names of one movie count once."""
    names = F.array_distinct(S.genre_array(F.col("genres")))
    return movies.select(F.col("movieId").alias("id"), F.explode(names).alias("genre")).select(
        "id", F.concat(F.lit("genre="), "genre").alias("feature"), F.lit(1.0).alias("weight")
    )


def decade_one_hot(movies: DataFrame) -> DataFrame:
    era = S.decade(S.release_year(F.col("title")), "Unknown Era")
    return movies.select(
        F.col("movieId").alias("id"), F.concat(F.lit("decade="), era).alias("feature"), F.lit(1.0).alias("weight")
    )


def item_features(
    movies: DataFrame,
    metadata: DataFrame,
    max_terms: int = DEFAULTS.max_terms,
    stop_words: Sequence[str] = ENGLISH,
    decades: bool = True,
) -> DataFrame:
    """TF-IDF terms, genres and decades of every movie as ``(id, feature, weight)``."""
    terms = tfidf(combined_text(movies, metadata), max_terms, stop_words)
    rows = terms.select("id", F.concat(F.lit("term="), "term").alias("feature"), "weight")
    rows = rows.unionByName(genre_one_hot(movies))
    return rows.unionByName(decade_one_hot(movies)) if decades else rows


def numbered_features(features: DataFrame) -> DataFrame:
    """Feature names replaced by dense numbers, written once for reuse.

    The names are the vocabulary, the genres and the decades: a list of bounded length, so it is
    numbered by one window and sent to every task.
    """
    names = features.select("feature").distinct()
    numbers = names.select("feature", F.row_number().over(Window.orderBy("feature")).cast("bigint").alias("_number"))
    return stage(
        features.join(F.broadcast(numbers), "feature").select("id", F.col("_number").alias("feature"), "weight"),
        "features",
    )


def user_profiles(train: DataFrame, features: DataFrame) -> DataFrame:
    """Rating-weighted mean of the features of a user's movies: ``(id, feature, weight)``.

    The rating total runs over the movies that have features. A profile has at most as many rows
    as there are features, whatever the number of ratings; one row per rating is shuffled.
    """
    vectors = stage(packed(features), "vectors")
    rated = train.select(F.col("userId").alias("owner"), F.col("movieId").alias("id"), "rating")
    return weighted_means(rated, vectors).withColumnRenamed("owner", "id")


def profile_rounds(
    ratings: DataFrame, features: DataFrame, pairs: DataFrame | None = None, plan: BlockPlan = BlockPlan()
) -> int:
    """Rounds in which users are taken, so that each ships at most four feature entries per rating and pair on average.

    A rating takes the vector of its movie to its user, and so does a pair to be scored: many times the rows they come from.
    """
    sizes = features.groupBy(F.col("id").alias("movieId")).agg(F.count("*").alias("_n"))
    rows = ratings.select("movieId") if pairs is None else ratings.select("movieId").unionByName(pairs.select("movieId"))
    listed, entries = rows.join(sizes, "movieId", "left").agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    return max(1, ceil(entries / max(3 * plan.shipped, 4 * listed)))


def in_rounds(rounds: int, build: Callable[[Callable[[DataFrame, str], DataFrame]], DataFrame], label: str) -> DataFrame:
    """``build`` for the rows of a share of the users at a time, each result written before the next.

    ``build`` gets a function that restricts a table to the users of the round by the named column.
    """
    if rounds == 1:
        return build(lambda rows, owner: rows)
    done: DataFrame | None = None
    for number in range(rounds):

        def share(rows: DataFrame, owner: str, number: int = number) -> DataFrame:
            # Another hash than that of shuffles and blocks, which would leave some of them empty.
            return rows.filter(F.pmod(F.xxhash64(F.lit(_ROUND_SALT), F.col(owner)), F.lit(rounds)) == number)

        some = stage_alone(lambda: build(share), label)
        done = some if done is None else done.unionByName(some)
    return done


def similar_items(features: DataFrame, k: int = DEFAULTS.top_n, plan: BlockPlan = BlockPlan()) -> DataFrame:
    """``k`` most similar movies per movie; similarity kept as float as in a stored matrix."""
    return nearest_vectors(features, k, plan).select(
        F.col("left_id").alias("movieId"),
        F.col("right_id").alias("similar_id"),
        F.col("score").cast("float").alias("similarity"),
        "rank",
    )


def similar_to_title(movies: DataFrame, features: DataFrame, pattern: str, n: int = DEFAULTS.top_n) -> DataFrame:
    """Movies most similar to the first title that matches, similarity rounded to 3 places.

    Only the matched movie's row of the similarity matrix is formed.
    """
    unit = stage(unit_short_rows(features), "unit")
    wanted = search_titles(movies, pattern, 1).select(F.col("movieId").alias("id"))
    mine = unit.join(wanted, "id", "left_semi").select("feature", F.col("weight").alias("_mine"))
    scores = (
        unit.join(mine, "feature")
        .groupBy("id")
        .agg(S.rounded(F.sum(F.col("weight") * F.col("_mine"))).alias("_score"))
        .join(wanted, "id", "left_anti")
        .orderBy(F.desc("_score"), "id")
        .limit(n)
    )
    return scores.join(movies.select(F.col("movieId").alias("id"), "title"), "id").select(
        F.col("id").alias("movieId"), "title", F.round("_score", 3).alias("similarity")
    )


def content_based(
    train: DataFrame,
    users: DataFrame,
    features: DataFrame,
    top_n: int = DEFAULTS.top_n,
    plan: BlockPlan = BlockPlan(),
) -> DataFrame:
    """Top-n unseen movies per user by cosine between profile and features."""
    mine = train.join(users.select("userId"), "userId", "left_semi")
    rated = mine.select(F.col("userId").alias("owner"), F.col("movieId").alias("id"), "rating")
    vectors, items = stage(packed(features), "vectors"), stage(packed_units(features), "items")

    def lists(share: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        # A cosine does not depend on the length of a profile, so the sums serve as well as the means.
        sums = weighted_sums(share(rated, "owner"), vectors).withColumnRenamed("owner", "id")
        return top_products(packed_units(sums), items, top_n, skip=seen_pairs(share(mine, "userId")), plan=plan)

    found = in_rounds(profile_rounds(mine, features, plan=plan), lists, "lists")
    return found.select(
        F.col("left_id").alias("userId"),
        "rank",
        F.col("right_id").alias("movieId"),
        S.clip_rating(F.col("score") * 5).alias("predicted_rating"),
        F.lit("Content-Based").alias("method"),
    )


def content_scores(pairs: DataFrame, profiles: DataFrame, features: DataFrame, rounds: int = 1) -> DataFrame:
    """Content score of given (userId, movieId) pairs, 2.5 where either side is unknown.

    Vectors are packed: a pair is one row, whatever the number of its terms. With several ``rounds`` (see ``profile_rounds``) the
    profiles of a share of the users are formed at a time, if ``profiles`` is not written yet.
    """
    items = packed_units(features) if rounds == 1 else stage(packed_units(features), "items")
    width = features.agg(F.coalesce(F.max("feature"), F.lit(0))).first()[0]
    named = pairs.withColumnsRenamed({"userId": "id", "movieId": "key"})

    def scores(share: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        users = packed_units(share(profiles, "id"))
        scored = pair_products(share(named, "id"), users, items, width).withColumnsRenamed({"id": "userId", "key": "movieId"})
        score = F.coalesce(S.clip_rating(F.col("product") * 5), F.lit(NEUTRAL_SCORE))
        return scored.withColumn("content_score", S.rounded(score)).select(*pairs.columns, "content_score")

    return in_rounds(rounds, scores, "content_scores")


def principal_components(vectors: DataFrame, k: int = 2, column: str = "features"):
    """Projection on the first ``k`` components and the share of variance of each.

    The covariance matrix is columns x columns; meant for vectors of some hundred columns.
    """
    centred = StandardScaler(inputCol=column, outputCol="_centred", withMean=True, withStd=False).fit(vectors)
    rows = centred.transform(vectors)
    model = PCA(k=k, inputCol="_centred", outputCol="components").fit(rows)
    return model.transform(rows).drop("_centred"), model.explainedVariance


def dense_features(features: DataFrame, items: int | None = None) -> DataFrame:
    """Dense feature rows of all movies, or of the first ``items`` ids if the caller asks for so few."""
    width = features.agg(F.max("feature")).first()[0] or 0
    if items is not None:
        chosen = features.select("id").distinct().orderBy("id").limit(items)
        features = features.join(chosen, "id", "left_semi")
    # A row holds at most one entry per feature.
    return packed(features).select(F.col("id").alias("movieId"), dense(F.col("entries"), width).alias("features"))
