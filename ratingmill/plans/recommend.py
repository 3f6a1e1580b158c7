"""Queries: rules, neighbours, text, content, factors, hybrid and evaluation."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators import (
    components,
    content,
    evaluation,
    factor,
    hybrid,
    itemsets,
    mips,
    neighbours,
    profile,
    rules,
    splitting,
    text,
)
from ratingmill.plans.base import QUERIES, centred_of, genre_rule_sql, lazy_train, query, rule_sql, split_of, sql, train_of
from ratingmill.session import fresh_path, stage
from ratingmill.sources import sinks
from ratingmill.sources import tables as T

# --- association rules ---------------------------------------------------------------------

_USER_MASKS = """SELECT userId AS owner, sum(DISTINCT coalesce(1 << bit, 0))::BIGINT AS mask
  FROM train t JOIN type_movies m USING (movieId) LEFT JOIN type_bits b ON b.genre = m.genres WHERE rating >= 3.5 GROUP BY 1"""
_ORDER_MASKS = """SELECT l_orderkey AS owner, sum(DISTINCT coalesce(1 << bit, 0))::BIGINT AS mask
  FROM rating_rows t JOIN type_movies m USING (movieId) LEFT JOIN type_bits b ON b.genre = m.genres WHERE rating >= 3.5 GROUP BY 1"""
_RULES_TAIL = """SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence,
  round(lift, 6) AS lift, round(leverage, 6) + 0.0 AS leverage FROM rules"""


def _shown(df):
    numbers = {c: S.rounded(F.col(c)) for c in ("support", "confidence", "lift", "leverage")}
    return rules.as_text(df).withColumns(numbers)


def _order_baskets(spark, folder):
    lines = T.rating_rows(spark, folder).select(F.col("l_orderkey").alias("orderId"), "movieId", "rating")
    return stage(rules.build_baskets(lines, T.type_movies(spark, folder), owner="orderId"), "baskets")


@query(
    sql(
        """SELECT userId, coalesce(string_agg(DISTINCT genre, ', ' ORDER BY genre), '') AS basket
           FROM train LEFT JOIN movie_genres USING (movieId) WHERE rating >= 3.5 GROUP BY 1""",
        "train", "movie_genres",
    )
)
def genre_baskets(spark, folder):
    baskets = rules.build_baskets(lazy_train(spark, folder), T.movies(spark, folder))
    return baskets.select("userId", F.array_join("basket", ", ").alias("basket"))


@query(rule_sql(_ORDER_MASKS, "SELECT items, freq AS frequency, round(support, 6) AS support FROM frequent", "rating_rows", "type_movies"))
def frequent_itemsets(spark, folder):
    found = rules.frequent_itemsets(_order_baskets(spark, folder))
    return found.select(F.array_join("items", ", ").alias("items"), "frequency", S.rounded(F.col("support")).alias("support"))


@query(rule_sql(_ORDER_MASKS, _RULES_TAIL, "rating_rows", "type_movies").replace(">= 0.4)", ">= 0.2)"))
def order_rules(spark, folder):
    return _shown(rules.mine_rules(_order_baskets(spark, folder), min_support=0.05, min_confidence=0.2))


@query(rule_sql(_USER_MASKS, _RULES_TAIL, "train", "type_movies"))
def user_rules(spark, folder):
    baskets = stage(rules.build_baskets(lazy_train(spark, folder), T.type_movies(spark, folder)), "baskets")
    return _shown(rules.mine_rules(baskets))


_LIKED_BY_ORDER = "SELECT l_orderkey AS owner, movieId FROM rating_rows WHERE rating >= 3.5"
_LIKED_BY_USER = "SELECT userId AS owner, movieId FROM train WHERE rating >= 3.5"
_ITEMSETS_TAIL = "SELECT items, freq AS frequency, round(support, 6) AS support FROM frequent"


def _genre_order_itemsets(spark, folder):
    lines = T.rating_rows(spark, folder).select(F.col("l_orderkey").alias("orderId"), "movieId", "rating")
    baskets = stage(rules.build_baskets(lines, T.movies(spark, folder), owner="orderId"), "baskets")
    return itemsets.frequent_itemsets(baskets, owner="orderId")


@query(genre_rule_sql(_LIKED_BY_ORDER, 0.05, 0.4, _ITEMSETS_TAIL, "rating_rows"))
def genre_itemsets(spark, folder):
    """Itemsets of all genres of the liked movies of an order."""
    found = _genre_order_itemsets(spark, folder)
    return found.select(F.array_join("items", ", ").alias("items"), "frequency", S.rounded(F.col("support")).alias("support"))


@query(genre_rule_sql(_LIKED_BY_ORDER, 0.05, 0.2, _RULES_TAIL, "rating_rows"))
def genre_order_rules(spark, folder):
    return _shown(rules.rules_by_lift(_genre_order_itemsets(spark, folder), 0.2))


_MOST = 0.6  # support of rules over all genres: users like most of the genres there are


def _common_genre_rules(baskets):
    return rules.rules_by_lift(itemsets.frequent_itemsets(baskets, _MOST))


@query(genre_rule_sql(_LIKED_BY_USER, _MOST, 0.4, _RULES_TAIL, "train"))
def genre_user_rules(spark, folder):
    """Rules between all genres a user likes; a basket holds most of them, so the support is that of most users."""
    baskets = stage(rules.build_baskets(lazy_train(spark, folder), T.movies(spark, folder)), "baskets")
    return _shown(_common_genre_rules(baskets))


def _genre_segment_sql(name: str, bound: str) -> str:
    liked = f"{_LIKED_BY_USER} AND userId IN (SELECT userId FROM means WHERE {bound})"
    return genre_rule_sql(liked, _MOST, 0.4, _RULES_TAIL.replace("SELECT", f"SELECT '{name}' AS segment,", 1), "train", "means")


@query(
    f"SELECT * FROM ({_genre_segment_sql('Overall System', 'true')}) UNION ALL "
    f"SELECT * FROM ({_genre_segment_sql('High-Rater Profile', 'm >= 3.0')}) UNION ALL "
    f"SELECT * FROM ({_genre_segment_sql('Low-Rater Profile', 'm <= 2.5')})"
)
def genre_segmented_rules(spark, folder):
    train = train_of(spark, folder)
    found = rules.segmented_rules(
        train, T.movies(spark, folder), profile.user_behaviour(train), high_mean=3.0, low_mean=2.5, mine=_common_genre_rules
    )
    return _shown(found)


def _segment_sql(name: str, bound: str) -> str:
    owners = _USER_MASKS.replace("WHERE rating", f"WHERE t.userId IN (SELECT userId FROM means WHERE {bound}) AND rating")
    return rule_sql(owners, _RULES_TAIL.replace("SELECT", f"SELECT '{name}' AS segment,", 1), "train", "type_movies", "means")


@query(
    f"SELECT * FROM ({_segment_sql('Overall System', 'true')}) UNION ALL "
    f"SELECT * FROM ({_segment_sql('High-Rater Profile', 'm >= 3.0')}) UNION ALL "
    f"SELECT * FROM ({_segment_sql('Low-Rater Profile', 'm <= 2.5')})"
)
def segmented_rules(spark, folder):
    train = train_of(spark, folder)
    found = rules.segmented_rules(
        train, T.type_movies(spark, folder), profile.user_behaviour(train), high_mean=3.0, low_mean=2.5
    )
    return _shown(found)


_TOP_RULES = """SELECT *, row_number() OVER (ORDER BY lift DESC, antecedents, consequents) AS place
  FROM (SELECT string_split(antecedents, ', ') AS antecedents, string_split(consequents, ', ') AS consequents, round(lift, 6) AS lift FROM rules)"""


def _rounded_rules(spark, folder):
    found = rules.mine_rules(_order_baskets(spark, folder), min_confidence=0.0)
    return found.withColumn("lift", S.rounded(F.col("lift")))


def _all_rules_sql(tail: str) -> str:
    return rule_sql(_ORDER_MASKS, tail, "rating_rows", "type_movies").replace(">= 0.4)", ">= 0.0)")


@query(_all_rules_sql(f"SELECT antecedents[1] AS source, consequents[1] AS target, max_by(lift, place) AS weight FROM ({_TOP_RULES}) WHERE place <= 35 GROUP BY 1, 2"))
def rule_graph_edges(spark, folder):
    return rules.graph_edges(_rounded_rules(spark, folder))


@query(_all_rules_sql(f"SELECT (SELECT count(*) FROM rules) AS total_rules, array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents, lift FROM ({_TOP_RULES}) WHERE place <= 10"))
def rule_summary(spark, folder):
    return rules.as_text(rules.rule_summary(stage(_rounded_rules(spark, folder), "rules")))


_FAVOURITES = """SELECT userId, genre, likes FROM (
  SELECT userId, genre, count(*) AS likes, row_number() OVER (PARTITION BY userId ORDER BY count(*) DESC, genre) AS n
  FROM train JOIN {genres} USING (movieId) WHERE rating >= 3.5 GROUP BY 1, 2) WHERE n = 1"""


@query(sql(_FAVOURITES.format(genres="movie_genres"), "train", "movie_genres"))
def favourite_genre(spark, folder):
    return rules.favourite_genre(lazy_train(spark, folder), T.movies(spark, folder))


@query(
    sql(
        "SELECT DISTINCT userId, movieId FROM train WHERE rating >= 3.5",
        "train",
    )
)
def liked_items_per_user(spark, folder):
    return lazy_train(spark, folder).filter("rating >= 3.5").select("userId", "movieId").distinct()


# --- neighbours ----------------------------------------------------------------------------


@query(sql("SELECT u AS userId, v AS neighbour, s AS similarity, rk AS rank FROM user_near", "user_near"))
def user_neighbours(spark, folder):
    return neighbours.user_neighbours(centred_of(spark, folder)[0])


@query(sql("SELECT i AS movieId, j AS neighbour, s AS similarity, rk AS rank FROM item_near", "item_near"))
def item_neighbours(spark, folder):
    return neighbours.item_neighbours(centred_of(spark, folder)[0])


@query(sql("SELECT * FROM ubcf", "ubcf"))
def user_based_recs(spark, folder):
    return neighbours.user_based(*centred_of(spark, folder))


@query(sql("SELECT * FROM ibcf", "ibcf"))
def item_based_recs(spark, folder):
    return neighbours.item_based(*centred_of(spark, folder))


# --- text and content ----------------------------------------------------------------------


def _features(spark, folder):
    return content.numbered_features(content.item_features(T.movies(spark, folder), T.metadata(spark, folder)))


@query(sql("SELECT id AS movieId, term, round(weight, 6) AS weight FROM tfidf", "tfidf"))
def tfidf_terms(spark, folder):
    docs = content.combined_text(T.movies(spark, folder), T.metadata(spark, folder))
    return text.tfidf(docs).select(F.col("id").alias("movieId"), "term", S.rounded(F.col("weight")).alias("weight"))


@query(sql("SELECT id AS movieId, feature, round(weight, 6)::DOUBLE AS weight FROM features", "features"))
def item_feature_table(spark, folder):
    rows = content.item_features(T.movies(spark, folder), T.metadata(spark, folder))
    return rows.select(F.col("id").alias("movieId"), "feature", S.rounded(F.col("weight")).alias("weight"))


@query(
    sql(
        """SELECT userId, count(*) AS features, round(sum(w), 5) AS total_weight, round(max(w), 6) AS top_weight
           FROM (SELECT userId, feature, sum(rating * weight) / (SELECT sum(rating) FROM train s WHERE s.userId = t.userId) AS w
                 FROM train t JOIN features ON id = movieId GROUP BY 1, 2) GROUP BY 1""",
        "train", "features",
    )
)
def user_profiles(spark, folder):
    """Profiles summarised per user: number, sum and maximum of the feature weights."""
    train, features = train_of(spark, folder), _features(spark, folder)
    profiles = content.user_profiles(train, features)

    def summary(share):
        return share(profiles, "id").groupBy(F.col("id").alias("userId")).agg(
            F.count("*").alias("features"),
            S.rounded(F.sum("weight"), 5).alias("total_weight"),
            S.rounded(F.max("weight")).alias("top_weight"),
        )

    return content.in_rounds(content.profile_rounds(train, features), summary, "profiles")


@query(
    sql(
        """SELECT movieId, similar_id, similarity, CAST(rk AS INTEGER) AS rank FROM (
             SELECT i AS movieId, j AS similar_id, s AS similarity, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS rk
             FROM (SELECT g.i, g.j, round(g / (a.n * b.n), 6) AS s FROM gram g JOIN item_norm a ON a.i = g.i
                   JOIN item_norm b ON b.i = g.j WHERE g.i <> g.j) WHERE s <> 0) WHERE rk <= 10""",
        "gram", "item_norm",
    )
)
def similar_items(spark, folder):
    rows = content.similar_items(_features(spark, folder))
    return rows.withColumn("similarity", S.rounded(F.col("similarity").cast("double")))


@query(
    sql(
        """SELECT j AS movieId, title, round(s, 3) AS similarity FROM (
             SELECT g.j, round(g / (a.n * b.n), 6) AS s FROM gram g JOIN item_norm a ON a.i = g.i JOIN item_norm b ON b.i = g.j
             WHERE g.i = (SELECT min(movieId) FROM movies WHERE regexp_matches(title, '(?i)red widget')) AND g.i <> g.j
             ORDER BY s DESC, g.j LIMIT 10) JOIN movies ON movieId = j""",
        "gram", "item_norm", "movies",
    )
)
def similar_to_title(spark, folder):
    return content.similar_to_title(T.movies(spark, folder), _features(spark, folder), "red widget")


@query(sql("SELECT * FROM content_recs", "content_recs"))
def content_recs(spark, folder):
    split = split_of(spark, folder)
    users = splitting.test_rows(split).select("userId").distinct()
    return content.content_based(splitting.train_rows(split), users, _features(spark, folder))


def _content_scores(spark, folder, split):
    features, train, test = _features(spark, folder), splitting.train_rows(split), splitting.test_rows(split)
    # Left where each user's ratings meet: written, the profiles would be by far the largest table here.
    profiles = content.user_profiles(train, features)
    return content.content_scores(test, profiles, features, content.profile_rounds(train, features, test))


@query(sql("SELECT userId, movieId, content_score FROM content_scores", "content_scores"))
def content_pair_scores(spark, folder):
    return _content_scores(spark, folder, split_of(spark, folder)).select("userId", "movieId", "content_score")


@query(
    """WITH e AS (SELECT vec_id AS id, i, embedding[i]::DOUBLE AS w FROM embeddings, range(1, 65) t(i)),
       n AS (SELECT id, sqrt(sum(w * w)) AS n FROM e GROUP BY id),
       s AS (SELECT a.id, b.id AS similar_id, round(sum(a.w * b.w) / (any_value(x.n) * any_value(y.n)), 6) AS similarity
             FROM e a JOIN e b ON a.i = b.i AND a.id <> b.id JOIN n x ON x.id = a.id JOIN n y ON y.id = b.id GROUP BY 1, 2)
       SELECT id AS vec_id, similar_id, similarity + 0.0 AS similarity, CAST(rk AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, similar_id) AS rk FROM s) WHERE rk <= 10"""
)
def similar_vectors(spark, folder):
    """Nearest dense vectors by cosine."""
    rows = T.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.posexplode("embedding").alias("feature", "weight")
    )
    typed = rows.select("id", F.col("feature").cast("bigint").alias("feature"), F.col("weight").cast("double").alias("weight"))
    return mips.nearest_vectors(typed, 10).select(
        F.col("left_id").alias("vec_id"), F.col("right_id").alias("similar_id"), F.col("score").alias("similarity"), "rank"
    )


@query()
def principal_components(spark, folder):
    """Every vector on its first two components, with the share of variance of each."""
    vectors = T.table(spark, folder, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    rows, shares = content.principal_components(vectors)
    pair = vector_to_array("components")
    return rows.select(
        "vec_id",
        "label",
        pair[0].alias("component_1"),
        pair[1].alias("component_2"),
        F.lit(float(shares[0])).alias("variance_share_1"),
        F.lit(float(shares[1])).alias("variance_share_2"),
    )


@query()
def feature_components(spark, folder):
    """Every movie on the first two components of its sparse features, with the share of variance of each."""
    rows, shares = components.sparse_components(_features(spark, folder))
    return rows.select(
        F.col("id").alias("movieId"),
        "component_1",
        "component_2",
        F.lit(shares[0]).alias("variance_share_1"),
        F.lit(shares[1]).alias("variance_share_2"),
    )


@query(
    sql(
        """SELECT id AS movieId, CAST((SELECT count(DISTINCT feature) FROM features) AS INTEGER) AS width,
             round(sum(weight), 6) AS total FROM features GROUP BY id""",
        "features",
    )
)
def dense_feature_rows(spark, folder):
    """One dense row per movie; its width and sum."""
    rows = content.dense_features(_features(spark, folder))
    total = F.expr("aggregate(features, 0D, (a, x) -> a + x)")
    return rows.select("movieId", F.size("features").alias("width"), S.rounded(total).alias("total"))


# --- factor model --------------------------------------------------------------------------


@query(
    sql(
        """SELECT userId, movieId, rating, round(mu + coalesce(bu, 0) + coalesce(bi, 0), 6) AS cf_score
           FROM test LEFT JOIN user_bias USING (userId) LEFT JOIN item_bias USING (movieId), global_mean""",
        "test", "user_bias", "item_bias", "global_mean",
    )
)
def bias_baseline(spark, folder):
    split = split_of(spark, folder)
    scored = factor.baseline_scores(splitting.test_rows(split), *factor.biases(splitting.train_rows(split)))
    return scored.select("userId", "movieId", "rating", S.rounded(F.col("cf_score")).alias("cf_score"))


@query()
def factor_predictions(spark, folder):
    split = split_of(spark, folder)
    model = factor.BiasedFactors().fit(splitting.train_rows(split))
    return model.transform(splitting.test_rows(split).select("userId", "movieId", "rating"))


@query()
def factor_recs(spark, folder):
    split = split_of(spark, folder)
    train = splitting.train_rows(split)
    model = factor.BiasedFactors().fit(train)
    return model.recommend(train, splitting.test_rows(split).select("userId").distinct())


def _list_facts(recs, users, train):
    """What any set of lists must hold: one row."""
    seen = recs.join(train.select("userId", "movieId"), ["userId", "movieId"], "left_semi").count()
    per_user = recs.groupBy("userId").agg(
        F.count("*").alias("n"), F.count_distinct("rank").alias("ranks"), F.max("rank").alias("deepest"), F.count_distinct("movieId").alias("movies")
    )
    odd = per_user.filter("n <> ranks OR n <> deepest OR n <> movies").count()
    strangers = per_user.join(users, "userId", "left_anti").count()
    return recs.agg(
        F.count_distinct("userId").alias("users"),
        F.count("*").alias("listed"),
        F.count_if((F.col("predicted_rating") < 0.5) | (F.col("predicted_rating") > 5)).alias("out_of_range"),
        F.lit(seen).cast("bigint").alias("seen"),
        F.lit(odd).cast("bigint").alias("odd_lists"),
        F.lit(strangers).cast("bigint").alias("strangers"),
    )


_LIST_FACTS = """SELECT count(DISTINCT userId) AS users, sum(least(10, free))::BIGINT AS listed, 0::BIGINT AS out_of_range, 0::BIGINT AS seen,
  0::BIGINT AS odd_lists, 0::BIGINT AS strangers FROM (SELECT userId, count(*) AS free FROM unseen GROUP BY 1)"""


@query(sql(_LIST_FACTS, "unseen"))
def factor_list_facts(spark, folder):
    """Lists of the factor model: every test user with factors has ten unseen movies, ranked without gaps."""
    split = split_of(spark, folder)
    train, users = splitting.train_rows(split), splitting.test_rows(split).select("userId").distinct()
    return _list_facts(stage(factor.BiasedFactors().fit(train).recommend(train, users), "recs"), users, train)


@query(sql("SELECT userId, row_number() OVER (ORDER BY userId) - 1 AS userId_index FROM (SELECT DISTINCT userId FROM train)", "train"))
def dense_user_index(spark, folder):
    """Dense numbers of the users as the factor model takes them."""
    return factor.index_ids(lazy_train(spark, folder), "userId").withColumn("userId_index", F.col("userId_index").cast("bigint"))


@query()
def factor_grid_search(spark, folder):
    _, table = factor.grid_search(train_of(spark, folder))
    return table


@query(sql("SELECT count(*) AS pairs, 0.0::DOUBLE AS largest_difference FROM test", "test"))
def factor_model_store(spark, folder):
    """A saved and reloaded model predicts the same."""
    split = split_of(spark, folder)
    model = factor.BiasedFactors().fit(splitting.train_rows(split))
    path = fresh_path(spark, "factor_model")
    model.save(path)
    pairs = splitting.test_rows(split).select("userId", "movieId")
    before = model.transform(pairs)
    after = factor.FactorModel.load(spark, path).transform(pairs).withColumnRenamed("prediction", "reloaded")
    return before.join(after, ["userId", "movieId"]).agg(
        F.count("*").alias("pairs"), F.max(F.abs(F.col("prediction") - F.col("reloaded"))).alias("largest_difference")
    )


# --- hybrid --------------------------------------------------------------------------------


def _scored(spark, folder, split):
    scored = _content_scores(spark, folder, split)
    return factor.baseline_scores(scored, *factor.biases(splitting.train_rows(split)))


_SWEEP = """sweep AS (SELECT a / 10 AS alpha, round(sqrt(avg(pow(rating - (a / 10 * cf_score + (1 - a / 10) * content_score), 2))), 6) AS rmse
  FROM scored, (SELECT unnest(range(0, 11))::DOUBLE AS a) GROUP BY 1)"""


@query(sql("", "scored").rstrip() + ",\n" + _SWEEP + " SELECT * FROM sweep")
def alpha_sweep(spark, folder):
    """Blend of bias baseline and content over the whole test part."""
    return hybrid.alpha_sweep(_scored(spark, folder, split_of(spark, folder)))


@query(sql("", "scored").rstrip() + ",\n" + _SWEEP + " SELECT alpha, rmse FROM sweep ORDER BY rmse, alpha LIMIT 1")
def best_alpha(spark, folder):
    return hybrid.best_alpha(hybrid.alpha_sweep(_scored(spark, folder, split_of(spark, folder))))


def _factor_scored(spark, folder, split, model):
    """Content scores and factor estimates of all test pairs."""
    return model.transform(_content_scores(spark, folder, split)).withColumnRenamed("prediction", "cf_score")


@query()
def alpha_sweep_factors(spark, folder):
    """Factor model against content over the whole test part."""
    split = split_of(spark, folder)
    model = factor.BiasedFactors().fit(splitting.train_rows(split))
    return hybrid.alpha_sweep(_factor_scored(spark, folder, split, model))


@query(
    sql("SELECT userId, movieId, rating FROM test ORDER BY md5(userId || '-' || movieId), userId, movieId LIMIT 2000", "test")
)
def tuning_rows(spark, folder):
    """The fixed sample for quick tuning; its size is the feature."""
    return hybrid.tuning_sample(splitting.test_rows(split_of(spark, folder))).select("userId", "movieId", "rating")


def _tuned(scored):
    """The best weight of the sweep, one number."""
    return hybrid.best_alpha(hybrid.alpha_sweep(scored)).first()["alpha"]


@query(
    sql("", "scored", "train").rstrip() + ",\n" + _SWEEP + """, tuned AS (SELECT alpha FROM sweep ORDER BY rmse, alpha LIMIT 1)
SELECT userId, movieId, round(a * cf_score + (1 - a) * content_score, 6) AS hybrid_score, route
           FROM (SELECT *, CASE WHEN n < 5 THEN 0.0 WHEN n <= 20 THEN 0.4 ELSE alpha END::DOUBLE AS a,
                   CASE WHEN n < 5 THEN 'Cold-Start (Pure CBF)' WHEN n <= 20 THEN 'Mild-Start (Heavy CBF)'
                        ELSE 'Dense-Data (Alpha ' || alpha || ')' END AS route
                 FROM (SELECT s.*, coalesce(n, 0) AS n FROM scored s LEFT JOIN (SELECT userId, count(*) AS n FROM train GROUP BY 1) USING (userId)), tuned)"""
)
def routed_scores(spark, folder):
    """Scores routed by the user's number of ratings, with the weight that the sweep finds best."""
    split = split_of(spark, folder)
    counts = profile.count_per(splitting.train_rows(split), "userId")
    scored = stage(_scored(spark, folder, split), "scored")
    return hybrid.routed_scores(scored, counts, _tuned(scored)).select("userId", "movieId", "hybrid_score", "route")


def _hybrid(spark, folder, split):
    train = splitting.train_rows(split)
    model = factor.BiasedFactors().fit(train)
    users = splitting.test_rows(split).select("userId").distinct()
    alpha = _tuned(_factor_scored(spark, folder, split, model))
    return hybrid.hybrid_recommendations(model, train, users, _features(spark, folder), alpha)


@query()
def hybrid_recs(spark, folder):
    return _hybrid(spark, folder, split_of(spark, folder))


@query()
def boosted_hybrid_recs(spark, folder):
    """The whole chain: tuned weight, hybrid lists, the rule boost over all genres, and the lists of every collaborative method beside them."""
    split = split_of(spark, folder)
    train, users = splitting.train_rows(split), splitting.test_rows(split).select("userId").distinct()
    movies = T.movies(spark, folder)
    recs = stage(_hybrid(spark, folder, split), "hybrid")
    found = rules.rules_by_lift(_genre_order_itemsets(spark, folder), 0.0)
    boosted = hybrid.boost_with_rules(recs, rules.favourite_genre(train, movies), found, movies, train)
    centred = neighbours.centred_train(train)
    by_factors = factor.BiasedFactors().fit(train).recommend(train, users)
    return neighbours.pool(boosted, neighbours.user_based(centred, users), neighbours.item_based(centred, users), by_factors)


_BOOST = rule_sql(_ORDER_MASKS, "", "rating_rows", "type_movies", "ubcf", "train").rstrip() + f""",
best AS (SELECT antecedents AS genre, consequents AS consequent FROM (
  SELECT *, row_number() OVER (PARTITION BY antecedents ORDER BY round(lift, 6) DESC, consequents) AS k FROM rules WHERE na = 1 AND nc = 1)
  WHERE k = 1),
fav AS ({_FAVOURITES.format(genres="(SELECT movieId, genres AS genre FROM type_movies WHERE genres <> '')")}),
target AS (SELECT u.userId, f.genre, b.consequent FROM (SELECT DISTINCT userId FROM ubcf) u JOIN fav f USING (userId) JOIN best b USING (genre)),
lacking AS (SELECT * FROM target t WHERE (SELECT count(*) FROM ubcf r JOIN type_movies m USING (movieId)
  WHERE r.userId = t.userId AND m.genres = t.consequent) < 2),
votes AS (SELECT m.movieId, m.genres, count(t.userId) AS votes FROM type_movies m LEFT JOIN train t USING (movieId) GROUP BY 1, 2),
ranked AS (SELECT l.userId, l.genre, l.consequent, v.movieId, row_number() OVER (PARTITION BY l.userId ORDER BY votes DESC, v.movieId) AS k
  FROM lacking l JOIN votes v ON v.genres = l.consequent
  WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.userId = l.userId AND x.movieId = v.movieId)
    AND NOT EXISTS (SELECT 1 FROM ubcf x WHERE x.userId = l.userId AND x.movieId = v.movieId)),
injected AS (SELECT userId, 10 AS rank, movieId, 4.75::DOUBLE AS predicted_rating,
  'Assoc-Rule Boost [' || genre || ' -> ' || consequent || ']' AS method FROM ranked WHERE k = 1)
SELECT userId, rank, movieId, round(predicted_rating, 6) AS predicted_rating, method FROM ubcf u
WHERE NOT (userId IN (SELECT userId FROM injected) AND rank = (SELECT max(rank) FROM ubcf x WHERE x.userId = u.userId))
UNION ALL SELECT * FROM injected"""


@query(_BOOST.replace(">= 0.4)", ">= 0.0)"))
def rule_boost(spark, folder):
    """Rule boost on user-based lists, with order-level rules between movie types."""
    centred, users = centred_of(spark, folder)
    recs = stage(neighbours.user_based(centred, users), "recs")
    kinds = T.type_movies(spark, folder)
    found = rules.mine_rules(_order_baskets(spark, folder), min_confidence=0.0)
    boosted = hybrid.boost_with_rules(recs, rules.favourite_genre(centred, kinds), found, kinds, centred)
    return boosted.withColumn("predicted_rating", S.rounded(F.col("predicted_rating")))


# --- evaluation ----------------------------------------------------------------------------


def _pooled(spark, folder):
    split = split_of(spark, folder)
    train = splitting.train_rows(split)
    users = splitting.test_rows(split).select("userId").distinct()
    centred = neighbours.centred_train(train)
    recs = neighbours.pool(neighbours.user_based(centred, users), neighbours.item_based(centred, users))
    return stage(recs, "pooled"), split


def _lists(spark, folder):
    """Lists of every family that has a definite result, and the split they are made of."""
    pooled, split = _pooled(spark, folder)
    users = splitting.test_rows(split).select("userId").distinct()
    by_content = content.content_based(splitting.train_rows(split), users, _features(spark, folder))
    return stage(neighbours.pool(pooled, by_content), "lists"), split


@query(sql("SELECT userId, rank, movieId, round(predicted_rating, 6) AS predicted_rating, method FROM pooled", "pooled"))
def pooled_recs(spark, folder):
    return _pooled(spark, folder)[0].withColumn("predicted_rating", S.rounded(F.col("predicted_rating")))


_FAMILIES = {"Baseline": "cf_score", "Content": "content_score", "Blend": "blend", "UBCF": "ubcf", "IBCF": "ibcf"}
_ACCURACY = sql(
    """SELECT model, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae
       FROM (SELECT model, least(5.0, greatest(0.5, p)) - rating AS e FROM ("""
    + " UNION ALL ".join(f"SELECT '{m}' AS model, {c} AS p, rating FROM family_scores" for m, c in _FAMILIES.items())
    + ")) WHERE e IS NOT NULL GROUP BY model",
    "family_scores",
)


def _family_scores(spark, folder, split):
    """Estimates of every test pair by each family; only the listed pairs are scored."""
    centred = neighbours.centred_train(splitting.train_rows(split))
    scored = stage(_scored(spark, folder, split).withColumn("blend", F.col("cf_score") * 0.7 + F.col("content_score") * 0.3), "scored")
    scored = neighbours.item_based_scores(neighbours.user_based_scores(scored, centred), centred)
    return stage(scored, "families")


@query(_ACCURACY)
def accuracy(spark, folder):
    """Error of each family over the whole test part."""
    return evaluation.accuracy(_family_scores(spark, folder, split_of(spark, folder)), _FAMILIES)


def _all_family_scores(spark, folder):
    """As ``_family_scores`` with the factor model and the routed hybrid of factors and content."""
    split = split_of(spark, folder)
    train = splitting.train_rows(split)
    model = factor.BiasedFactors().fit(train)
    scored = model.transform(_family_scores(spark, folder, split)).withColumnsRenamed({"cf_score": "baseline", "prediction": "cf_score"})
    scored = stage(scored, "factors")
    routed = hybrid.routed_scores(scored, profile.count_per(train, "userId"), _tuned(scored))
    return stage(routed.withColumnsRenamed({"cf_score": "factors", "baseline": "cf_score"}), "routed")


@query()
def accuracy_with_factors(spark, folder):
    """The same with the factor model and the hybrid of factors and content in the table."""
    return evaluation.accuracy(_all_family_scores(spark, folder), _FAMILIES | {"SVD": "factors", "Hybrid": "hybrid_score"})


def _blended(spark, folder):
    scored = _scored(spark, folder, split_of(spark, folder))
    return scored.withColumn("blend", F.col("cf_score") * 0.7 + F.col("content_score") * 0.3)


@query(
    sql(
        """SELECT m AS model, unnest(['rmse', 'mae']) AS metric, unnest([round(sqrt(avg(e * e)), 4), round(avg(abs(e)), 4)]) AS score
           FROM (SELECT 'Baseline' AS m, least(5.0, greatest(0.5, cf_score)) - rating AS e FROM scored
             UNION ALL SELECT 'Content', content_score - rating FROM scored) GROUP BY m""",
        "scored",
    )
)
def metrics_melt(spark, folder):
    scored = _scored(spark, folder, split_of(spark, folder))
    table = evaluation.accuracy(scored, {"Baseline": "cf_score", "Content": "content_score"})
    return profile.melt(table, ["model"], ["rmse", "mae"])


@query(
    sql(
        """SELECT count(*) AS n, round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 4) AS t_stat FROM (
             SELECT pow(rating - least(5.0, greatest(0.5, cf_score)), 2)
               - pow(rating - least(5.0, greatest(0.5, 0.7 * cf_score + 0.3 * content_score)), 2) AS d FROM scored)""",
        "scored",
    )
)
def paired_t_test(spark, folder):
    return evaluation.paired_t_test(_blended(spark, folder), "cf_score", "blend").select("n", "t_stat")


@query()
def paired_t_test_p_value(spark, folder):
    """Squared errors of the factor model against those of the hybrid."""
    return evaluation.paired_t_test(_all_family_scores(spark, folder), "factors", "hybrid_score")


def _quality_sql(k: int) -> str:
    return f"""SELECT method, {k} AS k, round(avg(hits / {k}), 5) AS precision, round(avg(hits / rel), 5) AS recall,
      round(avg(dcg / (SELECT sum(1 / log2(i + 1)) FROM range(1, {k} + 1) t(i) WHERE i <= rel)), 5) AS ndcg
    FROM (SELECT method, userId, any_value(rel) AS rel, count(*) FILTER (hit AND rank <= {k}) AS hits,
            coalesce(sum(1 / log2(rank + 1)) FILTER (hit AND rank <= {k}), 0) AS dcg FROM hits GROUP BY 1, 2) GROUP BY method"""


@query(
    sql("", "pooled_families", "test").rstrip()
    + """, liked AS (SELECT userId, movieId FROM test WHERE rating >= 3.5),
    hits AS (SELECT f.method, f.userId, f.rank, rel, l.movieId IS NOT NULL AS hit FROM pooled_families f
      JOIN (SELECT userId, count(*) AS rel FROM liked GROUP BY 1) USING (userId)
      LEFT JOIN liked l ON l.userId = f.userId AND l.movieId = f.movieId) """
    + " UNION ALL ".join(_quality_sql(k) for k in (5, 10, 20))
)
def ranking_quality(spark, folder):
    recs, split = _lists(spark, folder)
    return evaluation.ranking_quality(recs, splitting.test_rows(split))


@query(
    sql(
        """SELECT method, round(count(DISTINCT movieId) * 100.0 / (SELECT count(*) FROM movies), 2) AS coverage_percent
           FROM pooled_families GROUP BY 1""",
        "pooled_families", "movies",
    )
)
def catalog_coverage(spark, folder):
    return evaluation.coverage(_lists(spark, folder)[0], T.movies(spark, folder))


@query(
    sql("", "pooled_families", "train").rstrip()
    + """, pop AS (SELECT movieId, count(*) AS n FROM train GROUP BY 1)
    SELECT method, round(avg(s), 4) AS serendipity FROM (
      SELECT method, userId, avg(CASE WHEN n <= (SELECT median(n) FROM pop) THEN 1 ELSE 0 END) AS s
      FROM pooled_families LEFT JOIN pop USING (movieId) GROUP BY 1, 2) GROUP BY 1"""
)
def serendipity(spark, folder):
    recs, split = _lists(spark, folder)
    return evaluation.serendipity(recs, splitting.train_rows(split))


@query(
    sql("", "pooled_families", "movie_genres").rstrip()
    + """, g AS (SELECT f.method, f.userId, f.rank, coalesce(l, []) AS l FROM pooled_families f
      LEFT JOIN (SELECT movieId, list(DISTINCT genre) AS l FROM movie_genres GROUP BY 1) USING (movieId)),
    d AS (SELECT a.method, a.userId, 1 - len(list_intersect(a.l, b.l)) / nullif(len(list_distinct(a.l || b.l)), 0) AS d
      FROM g a JOIN g b ON a.method = b.method AND a.userId = b.userId AND a.rank < b.rank)
    SELECT method, round(avg(coalesce(x, 0)), 4) AS diversity FROM (SELECT method, userId, avg(d) AS x FROM d GROUP BY 1, 2) GROUP BY 1"""
)
def list_diversity(spark, folder):
    return evaluation.diversity(_lists(spark, folder)[0], T.movies(spark, folder))


def _report_sql(section: str, body: str, method: str, values: tuple[str, ...]) -> str:
    parts = [f"SELECT '{section}' AS section, {method} AS method, '{v}' AS metric, {v}::DOUBLE AS value FROM ({body})" for v in values]
    return " UNION ALL ".join(parts)


@query(
    " UNION ALL ".join(
        [
            _report_sql("Accuracy", _ACCURACY, "model", ("rmse", "mae")),
            _report_sql("Ranking_Metrics", QUERIES["ranking_quality"].sql, "method || '@' || k", ("precision", "recall", "ndcg")),
            _report_sql("Beyond_Accuracy", QUERIES["catalog_coverage"].sql, "method", ("coverage_percent",)),
            _report_sql("Beyond_Accuracy", QUERIES["list_diversity"].sql, "method", ("diversity",)),
            _report_sql("Beyond_Accuracy", QUERIES["serendipity"].sql, "method", ("serendipity",)),
        ]
    )
)
def metrics_report(spark, folder):
    """All metrics as one long table, written as JSON and read back; the accuracy table is written as markdown beside it."""
    recs, split = _lists(spark, folder)
    movies = T.movies(spark, folder)
    table = stage(evaluation.accuracy(_family_scores(spark, folder, split), _FAMILIES), "accuracy")
    report = evaluation.metrics_report(
        {
            "Accuracy": table,
            "Ranking_Metrics": evaluation.ranking_quality(recs, splitting.test_rows(split)),
            "Beyond_Accuracy": evaluation.beyond_accuracy(recs, movies, splitting.train_rows(split)),
        },
        {"Accuracy": ["model"], "Ranking_Metrics": ["method", "k"], "Beyond_Accuracy": ["method"]},
    )
    path = fresh_path(spark, "report")
    sinks.write_json(report, path)
    sinks.write_text(spark, evaluation.markdown_table(table, "model"), f"{path}-markdown")
    return spark.read.schema(report.schema).json(path)


@query(
    sql(
        "SELECT rank, title AS movie_title, genres, round(predicted_rating, 6) AS predicted_score, method AS origin FROM ubcf LEFT JOIN movies USING (movieId)",
        "ubcf", "movies",
    )
)
def recommendation_listing(spark, folder):
    """Recommendations with titles under display names."""
    recs = neighbours.user_based(*centred_of(spark, folder))
    shown = recs.join(T.movies(spark, folder), "movieId", "left")
    named = shown.withColumnsRenamed({"title": "movie_title", "predicted_rating": "predicted_score", "method": "origin"})
    return named.drop("movieId", "userId").withColumn("predicted_score", S.rounded(F.col("predicted_score")))
