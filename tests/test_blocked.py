"""Block products against numpy, with limits small enough to force every path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingmill.operators.blocked import (
    WEIGHTED_MEAN,
    BlockPlan,
    blocked_matrix,
    blocked_topk,
    cosine_topk,
    nearest_topk,
)

PLANS = {
    "default": BlockPlan(),
    "small_blocks": BlockPlan(left_ids=7, right_ids=5, entries=40),
    "long_rows": BlockPlan(left_ids=7, right_ids=5, entries=40, long_row=6),
}


def _matrix(seed, rows, cols, density):
    rng = np.random.default_rng(seed)
    m = np.round(rng.normal(size=(rows, cols)), 2) * (rng.random((rows, cols)) < density)
    m[0, :] = np.round(rng.normal(size=cols), 2)  # an id with every feature
    m[:, 0] = np.round(rng.normal(size=rows), 2)  # a feature of every id
    return m


def _long(spark, m):
    rows = [(i, j, float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    return spark.createDataFrame([(int(i), int(j), w) for i, j, w in rows], "id long, feature long, weight double")


def _want(scores, k, drop_zero=False):
    out = {}
    for i, row in enumerate(np.round(scores, 6) + 0.0):
        order = sorted((j for j in range(len(row)) if np.isfinite(row[j])), key=lambda j: (-row[j], j))[:k]
        out[i] = [(j, row[j]) for j in order if not (drop_zero and row[j] == 0)]
    return {i: v for i, v in out.items() if v}


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.left_id, r.rank)):
        out.setdefault(r.left_id, []).append((r.right_id, r.score))
    return out


@pytest.mark.parametrize("plan", PLANS)
def test_product_with_skipped_pairs(spark, plan):
    a, b = _matrix(1, 23, 11, 0.3), _matrix(2, 19, 11, 0.3)
    scores = a @ b.T
    skipped = [(i, j) for i in range(23) for j in range(19) if (i + j) % 4 == 0]
    for i, j in skipped:
        scores[i, j] = -np.inf
    skip = spark.createDataFrame(skipped, "id long, key long")
    found = blocked_topk(_long(spark, a), _long(spark, b), 6, skip=skip, plan=PLANS[plan])
    assert _got(found) == _want(scores, 6)


@pytest.mark.parametrize("plan", PLANS)
def test_cosine_includes_negative_only_when_zeros_run_out(spark, plan):
    a = _matrix(3, 21, 9, 0.25)
    unit = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -np.inf)
    assert _got(cosine_topk(_long(spark, a), 15, PLANS[plan])) == _want(scores, 15, drop_zero=True)


@pytest.mark.parametrize("plan", PLANS)
def test_weighted_mean_with_unknown_candidates(spark, plan):
    a, b = _matrix(4, 17, 8, 0.3), _matrix(5, 13, 8, 0.2)
    below = (a != 0).astype(float) @ np.abs(b).T
    scores = np.divide(a @ b.T, below, out=np.zeros_like(below), where=below != 0)
    scores = np.hstack([scores, np.zeros((17, 2))])
    more = spark.createDataFrame([(13,), (14,)], "id long")
    found = blocked_topk(
        _long(spark, a), _long(spark, b), 9, candidates=more, score=WEIGHTED_MEAN, plan=PLANS[plan]
    )
    assert _got(found) == _want(scores, 9)


def test_dense_rows_take_the_matrix_product(spark):
    rng = np.random.default_rng(6)
    a = np.round(rng.normal(size=(40, 12)), 2)
    scores = a @ a.T
    found = blocked_topk(_long(spark, a), _long(spark, a), 5)
    assert _got(found) == _want(scores, 5)


@pytest.mark.parametrize("plan", PLANS)
def test_whole_matrix(spark, plan):
    a = _matrix(7, 15, 6, 0.3)
    got = {(r.left_id, r.right_id): r.score for r in blocked_matrix(_long(spark, a), _long(spark, a), plan=PLANS[plan]).collect()}
    scores = np.round(a @ a.T, 9) + 0.0
    assert got == {(i, j): scores[i, j] for i, j in zip(*np.nonzero(scores))}


def test_hot_feature_is_spread_over_tasks(spark):
    """A feature of every id must not gather its rows in one group."""
    ids = 600
    rows = spark.range(ids).select(
        "id", F.lit(0).cast("bigint").alias("feature"), (F.col("id") % 7 + 1).cast("double").alias("weight")
    )
    plan = BlockPlan(left_ids=100, right_ids=100, entries=150)
    found = blocked_topk(rows, rows, 3, skip_self=True, plan=plan)
    w = np.array([i % 7 + 1.0 for i in range(ids)])
    scores = np.outer(w, w)
    np.fill_diagonal(scores, -np.inf)
    assert _got(found) == _want(scores, 3)


@pytest.mark.parametrize("plan", PLANS)
def test_nearest_ids_with_few_shared_features(spark, plan):
    """Most pairs share nothing; zeros stand before negative scores, so few of those are among the best."""
    rng = np.random.default_rng(9)
    m = np.zeros((40, 60))
    for i in range(40):
        m[i, rng.choice(60, 3, replace=False)] = np.round(rng.normal(size=3), 2)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -np.inf)
    for k in (3, 38):
        assert _got(cosine_topk(_long(spark, m), k, PLANS[plan])) == _want(scores, k, drop_zero=True)


def test_pairs_without_shared_features_are_not_formed(spark):
    """Two groups of ids with features of their own: a task meets an id only where it has a partner."""
    rows = [(i, i % 2, 1.0 + i) for i in range(40)]
    unit = spark.createDataFrame(rows, "id long, feature long, weight double")
    found = nearest_topk(unit, unit, 3, plan=BlockPlan(left_ids=1, right_ids=1, entries=1))
    assert {(r.left_id % 2) == (r.right_id % 2) for r in found.collect()} == {True} and found.count() == 120
