"""Scores of listed pairs and packed vectors against whole products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingmill.operators import vectors
from ratingmill.operators.blocked import DOT, WEIGHTED_MEAN, BlockPlan
from ratingmill.operators.sampled import sampled_scores

PLANS = {
    "one block": BlockPlan(),
    "small blocks": BlockPlan(left_ids=7, right_ids=5, entries=60),
    "long rows": BlockPlan(left_ids=11, right_ids=9, entries=200, long_row=12),
}


def _rows(spark, matrix):
    cells = [(int(i), int(f), float(matrix[i, f])) for i, f in zip(*np.nonzero(matrix))]
    return spark.createDataFrame(cells, "id bigint, feature bigint, weight double")


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("score", ["dot", "mean"])
def test_listed_pairs(spark, plan, score):
    rng = np.random.default_rng(4)
    left = np.where(rng.random((30, 40)) < 0.2, rng.normal(size=(30, 40)), 0)
    right = np.where(rng.random((25, 40)) < 0.3, rng.normal(size=(25, 40)), 0)
    left[3], right[4] = 0, 0  # ids without a row
    left[5] = rng.normal(size=40)  # a long row
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 32, 300), rng.integers(0, 25, 300))} | {(5, 4), (31, 0)})
    listed = spark.createDataFrame(pairs + pairs[:5], "id bigint, key bigint")
    whole = np.vstack([left, np.zeros((2, 40))])
    want = whole @ right.T
    if score == "mean":
        below = (whole != 0).astype(float) @ np.abs(right).T
        want = np.divide(want, below, out=np.zeros_like(want), where=below != 0)
    kind = DOT if score == "dot" else WEIGHTED_MEAN
    got = sampled_scores(_rows(spark, left), _rows(spark, right), listed, score=kind, plan=PLANS[plan]).collect()
    assert sorted((r["id"], r["key"]) for r in got) == pairs
    assert all(abs(r["score"] - want[r["id"], r["key"]]) < 2e-6 for r in got)


def test_no_pairs(spark):
    none = spark.createDataFrame([], "id bigint, key bigint")
    rows = _rows(spark, np.eye(3))
    assert sampled_scores(rows, rows, none).collect() == []


def test_packed_products(spark):
    rng = np.random.default_rng(5)
    left = np.where(rng.random((9, 12)) < 0.5, rng.random((9, 12)), 0)
    right = np.where(rng.random((8, 12)) < 0.3, rng.random((8, 12)), 0)
    left[2, :], right[3, :], left[:, 0], right[:, 0] = 0, 0, 0, 0  # features count from 1
    pairs = [(a, b) for a in range(10) for b in range(9)]
    listed = spark.createDataFrame(pairs, "id bigint, key bigint")
    packed = [vectors.packed_units(_rows(spark, m)) for m in (left, right)]
    got = {(r["id"], r["key"]): r["product"] for r in vectors.pair_products(listed, *packed, 11).collect()}
    assert len(got) == len(pairs)
    for (a, b), value in got.items():
        if a == 2 or b == 3 or a == 9 or b == 8 or not right[b].any():
            assert value is None
        else:
            want = left[a] @ right[b] / np.linalg.norm(left[a]) / np.linalg.norm(right[b])
            assert abs(value - want) < 1e-12


def test_weighted_means_shuffle_ratings_only(spark):
    """A rating is one shuffled row, however many features its vector has; a very active owner is pre-summed."""
    rng = np.random.default_rng(6)
    matrix = rng.random((20, 30))
    ratings = [(int(o), int(i), float(r)) for o, i, r in zip(rng.integers(0, 5, 100), rng.integers(0, 22, 100), rng.integers(1, 6, 100))]
    rated = spark.createDataFrame(ratings, "owner bigint, id bigint, rating double")
    means = vectors.weighted_means(rated, vectors.packed(_rows(spark, matrix)))
    got = {(r["owner"], r["feature"]): r["weight"] for r in means.collect()}
    for owner in range(5):
        own = [(i, r) for o, i, r in ratings if o == owner and i < 20]
        want = sum(r * matrix[i] for i, r in own) / sum(r for _, r in own)
        assert all(abs(got[owner, f] - want[f]) < 1e-12 for f in range(30))
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(owner" in plan and "Generate inline" in plan


def test_dense_rows(spark):
    rows = spark.createDataFrame([(1, 2, 0.5), (1, 4, 1.5), (2, 1, 2.0)], "id bigint, feature bigint, weight double")
    got = {r["id"]: r["d"] for r in vectors.packed(rows).select("id", vectors.dense(F.col("entries"), 5).alias("d")).collect()}
    assert got == {1: [0, 0.5, 0, 1.5, 0], 2: [2.0, 0, 0, 0, 0]}
