"""Block products in rounds: the same results, and a round ships no more than the input allows."""

import numpy as np
import pytest

from ratingmill.operators import blocked, content, sampled
from ratingmill.operators.blocked import BlockPlan, blocked_topk, cosine_topk
from ratingmill.session import stage, stage_alone

ROUNDS = BlockPlan(left_ids=7, right_ids=5, entries=40, held_ids=9, shipped=1)


def _sparse(seed, rows, cols, share):
    rng = np.random.default_rng(seed)
    return np.round(rng.normal(size=(rows, cols)), 2) * (rng.random((rows, cols)) < share)


def _long(spark, m):
    rows = [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "id long, feature long, weight double")


def _best(scores, k, known):
    want = {}
    for i in known:
        order = sorted((j for j in range(scores.shape[1]) if np.isfinite(scores[i, j])), key=lambda j: (-scores[i, j], j))[:k]
        want[int(i)] = [(j, scores[i, j]) for j in order]
    return {i: v for i, v in want.items() if v}


def _got(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.left_id, r.rank)):
        got.setdefault(r.left_id, []).append((r.right_id, r.score))
    return got


@pytest.mark.parametrize("plan", [ROUNDS, BlockPlan(entries=10**6)])
def test_unseen_ids_without_shared_features_compete(spark, plan):
    """Few scores are above 0, so the lowest ids of score 0 fill the lists, but not those skipped."""
    a, b = _sparse(1, 60, 400, 0.01), _sparse(2, 90, 400, 0.01)
    scores = np.hstack([np.round(a @ b.T, 6), np.zeros((60, 10))]) + 0.0
    skipped = [(i, j) for i in range(60) for j in range(100) if (i * j) % 3 == 0]
    for i, j in skipped:
        scores[i, j] = -np.inf
    more = spark.createDataFrame([(i,) for i in range(100)], "id long")
    skip = spark.createDataFrame(skipped, "id long, key long")
    found = blocked_topk(_long(spark, a), _long(spark, b), 12, candidates=more, skip=skip, plan=plan)
    assert _got(found) == _best(scores, 12, np.flatnonzero(a.any(1)))


def test_neighbours_in_rounds(spark):
    m = _sparse(3, 80, 50, 0.06)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    unit = m / np.where(norm == 0, 1, norm)
    scores = np.round(unit @ unit.T, 6) + 0.0
    np.fill_diagonal(scores, -np.inf)
    known = np.flatnonzero(m.any(1))
    scores[:, ~m.any(1)] = -np.inf
    want = {i: [c for c in v if c[1] != 0] for i, v in _best(scores, 6, known).items()}
    assert _got(cosine_topk(_long(spark, m), 6, ROUNDS)) == {i: v for i, v in want.items() if v}


def test_a_round_ships_a_bounded_multiple_of_the_input():
    """Entries a round ships per entry of the input, on 3 executors of 4 cores: users against users, weights against items."""
    for copies in (6, 60, 360):
        for left, right in ((480_000, 480_000), (300_000, 480_000), (480_000, 400_000)):
            lside, rside = blocked._Side(15_000 * copies, left * copies, False), blocked._Side(20_000 * copies, right * copies, False)
            plan = BlockPlan()
            blocks, at_once, slices = blocked._rounds(lside, rside, plan, 12)
            shipped = at_once * rside.entries + slices * lside.entries * at_once / blocks
            assert shipped <= max(plan.shipped + lside.entries * slices, 5 * (lside.entries + rside.entries))
            assert lside.entries / blocks <= plan.entries and at_once * slices >= 12


def test_null_features_are_shared_with_nothing(spark):
    rows = spark.createDataFrame([(1, 5, 1.0), (2, 5, 1.0), (3, None, 1.0)], "id long, feature long, weight double")
    found = blocked_topk(rows, rows, 5, skip_self=True)
    assert _got(found) == {1: [(2, 1.0), (3, 0.0)], 2: [(1, 1.0), (3, 0.0)], 3: [(1, 0.0), (2, 0.0)]}


def test_listed_pairs_in_rounds(spark):
    """Every pair once, whatever the round of its left id."""
    a, b = _sparse(4, 50, 30, 0.2), _sparse(5, 40, 30, 0.2)
    pairs = [(i, j) for i in range(50) for j in range(40) if (i + j) % 3 == 0]
    cells = spark.createDataFrame(pairs, "id long, key long")
    left, right = _long(spark, a), _long(spark, b)
    assert sampled._rounds(left, right, cells, ROUNDS) > 3
    got = {(r.id, r.key): r.score for r in sampled.sampled_scores(left, right, cells, plan=ROUNDS).collect()}
    scores = np.round(a @ b.T, 6)
    assert got.keys() == set(pairs) and all(abs(got[i, j] - scores[i, j]) < 2e-6 for i, j in pairs)


def test_content_lists_in_rounds(spark, monkeypatch):
    """Users taken in rounds get the lists of one round."""
    rng = np.random.default_rng(6)
    rows = [(u, int(m), float(rng.integers(1, 6)), 0) for u in range(40) for m in rng.choice(30, 5, replace=False)]
    train = spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    features = _long(spark, np.abs(_sparse(7, 30, 12, 0.4)) + np.eye(30, 12))
    users = train.select("userId").distinct()
    few = BlockPlan(shipped=1)
    written, alone = [], content.stage_alone
    monkeypatch.setattr(content, "stage_alone", lambda build, label: written.append(label) or alone(build, label))
    with_rounds = content.content_based(train, users, features, 4, few).collect()
    assert len(written) > 1
    assert sorted(map(tuple, with_rounds)) == sorted(map(tuple, content.content_based(train, users, features, 4).collect()))


def test_stage_alone_keeps_only_its_result(spark):
    inner = []

    def build():
        inner.append(stage(spark.range(5), "inner"))
        return stage_alone(lambda: inner[0].selectExpr("id + 1 AS id"), "nested").selectExpr("id * 2 AS id")

    kept = stage_alone(build, "kept")
    assert sorted(r.id for r in kept.collect()) == [2, 4, 6, 8, 10]
    with pytest.raises(Exception):
        inner[0].collect()
