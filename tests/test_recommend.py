"""Recommenders, rules and metrics against hand-made data and plain Python."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators import content, evaluation, factor, hybrid, neighbours, profile, rules, text

RATINGS = [
    (1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0),
    (2, 1, 4.5), (2, 2, 2.5), (2, 4, 5.0), (2, 5, 1.0),
    (3, 2, 5.0), (3, 3, 1.0), (3, 6, 4.0),
    (4, 1, 1.0), (4, 4, 2.0), (4, 6, 5.0), (4, 5, 3.5),
    (5, 3, 2.0), (5, 5, 4.5), (5, 6, 0.5),
]
GENRES = {1: "A|B", 2: "A", 3: "B|C", 4: "C", 5: "Unknown", 6: ""}


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame([(u, m, r, 0) for u, m, r in RATINGS], "userId long, movieId long, rating double, timestamp long")


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame([(m, f"Film {m} ({1990 + m})", g) for m, g in GENRES.items()], "movieId long, title string, genres string")


@pytest.fixture(scope="module")
def users(train):
    return train.select("userId").distinct()


def _centred():
    m, seen = np.zeros((5, 6)), np.zeros((5, 6), bool)
    for u, i, r in RATINGS:
        m[u - 1, i - 1], seen[u - 1, i - 1] = r, True
    means = np.array([m[u][seen[u]].mean() for u in range(5)])
    return np.where(seen, m - means[:, None], 0.0), seen, means


def _cosine(rows):
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    sim = (rows / np.where(norm == 0, 1, norm)) @ (rows / np.where(norm == 0, 1, norm)).T
    np.fill_diagonal(sim, 0)
    return sim


def _top(dev, seen, means, n):
    want = {}
    for u in range(5):
        order = sorted((i for i in range(6) if not seen[u, i]), key=lambda i: (-round(dev[u, i], 6), i))[:n]
        want[u + 1] = [(i + 1, min(5.0, max(0.5, means[u] + round(dev[u, i], 6)))) for i in order]
    return want


def _lists(recs):
    got = {}
    for r in sorted(recs.collect(), key=lambda r: (r.userId, r.rank)):
        got.setdefault(r.userId, []).append((r.movieId, r.predicted_rating))
        assert r["rank"] == len(got[r.userId])
    return got


def _same(got, want):
    assert got.keys() == want.keys()
    for u in want:
        assert [i for i, _ in got[u]] == [i for i, _ in want[u]]
        assert [p for _, p in got[u]] == pytest.approx([p for _, p in want[u]])


def test_user_based(train, users):
    centred, seen, means = _centred()
    sim, k = _cosine(centred), 3
    dev = np.zeros((5, 6))
    for u in range(5):
        near = np.argsort(np.where(np.arange(5) == u, -9, sim[u]))[-k:]
        dev[u] = sim[u][near] @ centred[near] / np.abs(sim[u][near]).sum()
    _same(_lists(neighbours.user_based(neighbours.centred_train(train), users, k=k, top_n=3)), _top(dev, seen, means, 3))


def test_item_based(train, users):
    centred, seen, means = _centred()
    sim = _cosine(centred.T)
    below = np.abs(sim) @ (centred != 0).T.astype(float)
    dev = np.divide(sim @ centred.T, below, out=np.zeros_like(below), where=below != 0).T
    _same(_lists(neighbours.item_based(neighbours.centred_train(train), users, top_n=3)), _top(dev, seen, means, 3))
    sparse = neighbours.item_based(neighbours.centred_train(train), users, top_n=3, max_neighbours=2)
    assert sparse.count() == 5 * 3 - sum(max(0, 3 - (6 - s.sum())) for s in seen)


def test_rules_match_enumeration(spark, train, movies):
    baskets = rules.build_baskets(train, movies, threshold=3.5)
    got = {r.userId: r.basket for r in baskets.collect()}
    want = {}
    for u, m, r in RATINGS:
        if r >= 3.5:
            want.setdefault(u, set()).update(g for g in GENRES[m].split("|") if g not in ("", "Unknown"))
    assert got == {u: sorted(b) for u, b in want.items()}

    def support(items):
        return sum(set(items) <= b for b in want.values()) / len(want)

    names = sorted(set().union(*want.values()))
    sets = [c for n in range(1, len(names) + 1) for c in combinations(names, n) if support(c) >= 0.2]
    expected = {}
    for s in sets:
        for n in range(1, len(s)):
            for a in combinations(s, n):
                c = tuple(x for x in s if x not in a)
                if support(s) / support(a) >= 0.4:
                    expected[a, c] = (
                        support(s), support(s) / support(a), support(s) / support(a) / support(c), support(s) - support(a) * support(c)
                    )
    found = rules.mine_rules(baskets, 0.2, 0.4).collect()
    assert {(tuple(r.antecedents), tuple(r.consequents)) for r in found} == expected.keys()
    for r in found:
        assert (r.support, r.confidence, r.lift, r.leverage) == pytest.approx(expected[tuple(r.antecedents), tuple(r.consequents)])
    assert [r.lift for r in found] == sorted((r.lift for r in found), reverse=True)


def test_tfidf_on_whole_texts(spark):
    docs = spark.createDataFrame(
        [(1, "The red fox and the red dog"), (2, "a RED cat x"), (3, ""), (4, "dog über Straße " + "filler " * 5000 + "zebra")],
        "id long, text string",
    )
    got = {(r.id, r.term): r.weight for r in text.tfidf(docs, 1000).collect()}
    lists = {1: "red fox red dog".split(), 2: "red cat".split(), 3: [], 4: ["dog", "über", "straße"] + ["filler"] * 5000 + ["zebra"]}
    counts = {}
    for i, w in lists.items():
        for t in w + [f"{a} {b}" for a, b in zip(w, w[1:])]:
            counts[i, t] = counts.get((i, t), 0) + 1
    df = {}
    for _, t in counts:
        df[t] = df.get(t, 0) + 1
    raw = {k: n * (math.log(5 / (1 + df[k[1]])) + 1) for k, n in counts.items()}
    norm = {i: math.sqrt(sum(v * v for k, v in raw.items() if k[0] == i)) for i in lists}
    assert got == pytest.approx({k: v / norm[k[0]] for k, v in raw.items()})


def test_vocabulary_keeps_the_most_frequent_terms(spark):
    rows = spark.createDataFrame([("b",)] * 3 + [("c",)] * 2 + [("a",)] * 2 + [("d",)], "term string")
    assert [r.term for r in text.vocabulary(rows, 2).collect()] == ["b", "a"]


def test_content_pairs_and_neutral_score(spark, train, movies):
    features = content.numbered_features(content.genre_one_hot(movies))
    profiles = content.user_profiles(train, features)
    pairs = spark.createDataFrame([(1, 4), (1, 6), (99, 1), (2, 3)], "userId long, movieId long")
    got = {(r.userId, r.movieId): r.content_score for r in content.content_scores(pairs, profiles, features).collect()}
    # Film 6 has no feature and user 99 no profile.
    assert got[1, 6] == got[99, 1] == 2.5
    p = np.array([5 + 3, 5 + 4, 4.0])  # A, B, C of user 1
    assert got[1, 4] == pytest.approx(5 * p[2] / np.linalg.norm(p), abs=1e-6)


def test_routes_by_activity(spark):
    rows = [(n, n) for n in (0, 4, 5, 20, 21)]
    scored = spark.createDataFrame([(u, 1, 4.0, 2.0) for u, _ in rows] + [(77, 1, 4.0, 2.0)], "userId long, movieId long, cf_score double, content_score double")
    counts = spark.createDataFrame(rows, "userId long, rating_count long")
    got = {r.userId: (r.hybrid_score, r.route) for r in hybrid.routed_scores(scored, counts, 0.7).collect()}
    assert got[0] == got[4] == got[77] == (2.0, "Cold-Start (Pure CBF)")
    assert got[5] == got[20] == (2.8, "Mild-Start (Heavy CBF)")
    assert got[21] == (3.4, "Dense-Data (Alpha 0.7)")


def test_hybrid_block_score_equals_pairwise_scores(spark, train, movies, users):
    features = content.numbered_features(content.genre_one_hot(movies))
    model = factor.BiasedFactors(rank=3, maxIter=3).fit(train)
    got = _lists(hybrid.hybrid_recommendations(model, train, users, features, 0.7, top_n=6))
    pairs = spark.createDataFrame([(u, m) for u in range(1, 6) for m in range(1, 7)], "userId long, movieId long")
    scored = model.transform(content.content_scores(pairs, content.user_profiles(train, features), features))
    counts = profile.count_per(train, "userId")
    routed = hybrid.routed_scores(scored.withColumnRenamed("prediction", "cf_score"), counts, 0.7).collect()
    seen = {(u, m) for u, m, _ in RATINGS}
    want = {}
    for r in sorted(routed, key=lambda r: (r.userId, -r.hybrid_score, r.movieId)):
        if (r.userId, r.movieId) not in seen:
            want.setdefault(r.userId, {})[r.movieId] = r.hybrid_score
    assert {u: dict(v) for u, v in got.items()} == {u: pytest.approx(v, abs=2e-6) for u, v in want.items()}


def test_factor_model_is_repeatable_and_falls_back(spark, train):
    pairs = spark.createDataFrame([(1, 4), (99, 1), (1, 99), (99, 99)], "userId long, movieId long")
    runs = [
        {(r.userId, r.movieId): r.prediction for r in factor.BiasedFactors(rank=2, maxIter=3).fit(train).transform(pairs).collect()}
        for _ in range(2)
    ]
    assert runs[0] == runs[1]
    mean, _, items = factor.biases(train)
    bias = {r.movieId: r.item_bias for r in items.collect()}
    assert runs[0][99, 99] == pytest.approx(mean)
    assert runs[0][99, 1] == pytest.approx(mean + bias[1])


def test_factor_recommendations_are_the_best_unseen(spark, train, users):
    model = factor.BiasedFactors(rank=3, maxIter=3).fit(train)
    got = _lists(model.recommend(train, users, top_n=2))
    pairs = spark.createDataFrame([(u, m) for u in range(1, 6) for m in range(1, 7)], "userId long, movieId long")
    seen = {(u, m) for u, m, _ in RATINGS}
    for u, listed in got.items():
        scores = {r.movieId: r.prediction for r in model.transform(pairs.filter(F.col("userId") == u)).collect() if (u, r.movieId) not in seen}
        assert [p for _, p in listed] == pytest.approx(sorted(scores.values(), reverse=True)[:2], abs=1e-5)


def test_boost_injects_most_rated_unseen_movie(spark, train, movies):
    recs = spark.createDataFrame([(1, 1, 5, 4.0, "UBCF"), (1, 2, 6, 3.0, "UBCF"), (3, 1, 1, 4.0, "UBCF")], "userId long, rank int, movieId long, predicted_rating double, method string")
    favourites = spark.createDataFrame([(1, "A"), (3, "Z")], "userId long, genre string")
    found = spark.createDataFrame([(["A"], ["B"], 1.1), (["A"], ["C"], 1.5), (["A", "B"], ["C"], 9.0)], "antecedents array<string>, consequents array<string>, lift double")
    got = hybrid.boost_with_rules(recs, favourites, found, movies, train).collect()
    by_user = {(r.userId, r["rank"]): (r.movieId, r.predicted_rating, r.method) for r in got}
    # User 1 has seen film 3, so film 4 is the most rated unseen film of genre C.
    assert by_user == {
        (1, 1): (5, 4.0, "UBCF"),
        (1, 10): (4, 4.75, "Assoc-Rule Boost [A -> C]"),
        (3, 1): (1, 4.0, "UBCF"),
    }


def test_ranking_metrics_by_hand(spark):
    recs = spark.createDataFrame(
        [(1, r, m, 5.0 - r / 10, "UBCF") for r, m in enumerate([10, 11, 12], 1)] + [(2, 1, 10, 4.0, "UBCF"), (3, 1, 10, 4.0, "Content-Based")],
        "userId long, rank int, movieId long, predicted_rating double, method string",
    )
    test = spark.createDataFrame([(1, 11, 4.0), (1, 50, 5.0), (1, 10, 2.0), (2, 10, 1.0), (3, 10, 3.5)], "userId long, movieId long, rating double")
    got = {(r.method, r.k): (r.precision, r.recall, r.ndcg) for r in evaluation.ranking_quality(recs, test, (5, 10)).collect()}
    ndcg = (1 / math.log2(3)) / (1 + 1 / math.log2(3))
    assert got["UBCF", 5] == pytest.approx((0.2, 0.5, ndcg), abs=1e-5)  # user 2 likes nothing
    assert got["Content", 10] == pytest.approx((0.1, 1.0, 1.0))


def test_diversity_and_serendipity_by_hand(spark, train, movies):
    recs = spark.createDataFrame([(1, 1, 1, 5.0, "X"), (1, 2, 2, 4.0, "X"), (1, 3, 6, 3.0, "X"), (2, 1, 6, 3.0, "X")], "userId long, rank int, movieId long, predicted_rating double, method string")
    # Pairs of user 1: {A,B}-{A} 0.5, {A,B}-{} 1, {A}-{} 1; user 2 has none.
    assert evaluation.diversity(recs, movies).first().diversity == pytest.approx((2.5 / 3 + 0) / 2, abs=1e-4)
    counts = {m: sum(x == m for _, x, _ in RATINGS) for m in GENRES}
    median = np.median(list(counts.values()))
    share = [np.mean([counts[m] <= median for m in ms]) for ms in ([1, 2, 6], [6])]
    assert evaluation.serendipity(recs, train).first().serendipity == pytest.approx(np.mean(share), abs=1e-4)


@pytest.mark.parametrize(("t", "dof", "p"), [(2.228139, 10, 0.05), (0.0, 5, 1.0), (12.7062, 1, 0.05), (-1.959966, 1e7, 0.05), (4.0, 30, 0.000382)])
def test_student_tail(t, dof, p):
    assert evaluation.student_tail(t, dof) == pytest.approx(p, rel=2e-3)


def test_method_families(spark):
    names = ["UBCF", "Content-Based", "Hybrid Matrix [Dense-Data (Alpha 0.7)]", "Assoc-Rule Boost [A -> B]", None]
    df = spark.createDataFrame([(n,) for n in names], "m string").select(S.method_family(F.col("m")).alias("f"))
    assert [r.f for r in df.collect()] == ["UBCF", "Content", "Hybrid", "Assoc", "Unknown"]


def test_activity_buckets_and_years(spark):
    df = spark.createDataFrame([(49,), (50,), (499,), (500,)], "n long")
    assert [r[0] for r in df.select(S.activity_level(F.col("n"))).collect()] == ["Low", "Medium", "Medium", "High"]
    titles = spark.createDataFrame([("Toy (1995)",), ("(19x5) no",), (None,), ("A (2001) (2003)",)], "t string")
    year = S.release_year(F.col("t"))
    assert [tuple(r) for r in titles.select(year, S.decade(year)).collect()] == [
        (1995, "1990s"), (None, "Unknown"), (None, "Unknown"), (2001, "2000s")
    ]
