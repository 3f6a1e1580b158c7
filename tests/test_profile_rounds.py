"""Profiles and content scores formed for a share of the users at a time."""

import numpy as np
from pyspark.sql import functions as F

from ratingmill.operators import content
from ratingmill.operators.blocked import BlockPlan


def _tables(spark):
    rng = np.random.default_rng(11)
    rated = [(u, int(m), float(rng.integers(1, 6))) for u in range(30) for m in rng.choice(20, 4, replace=False)] + [(None, 3, 4.0)]
    train = spark.createDataFrame(rated, "userId long, movieId long, rating double")
    weights = [(i, f, float(rng.integers(1, 9)) / 8) for i in range(18) for f in range(1, 28) if (i + f) % 3]
    features = spark.createDataFrame(weights, "id long, feature long, weight double")
    # Users 30 and 31 have no profile, movies 18 to 20 no features; one pair comes twice.
    listed = [(u, int(m)) for u in range(32) for m in rng.choice(21, 3, replace=False)] + [(None, 3), (5, 2), (5, 2)]
    return train, features, spark.createDataFrame(listed, "userId long, movieId long")


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_content_scores_in_rounds(spark, monkeypatch):
    train, features, pairs = _tables(spark)
    profiles = content.user_profiles(train, features)
    at_once = _sorted(content.content_scores(pairs, profiles, features))
    written, alone = [], content.stage_alone
    monkeypatch.setattr(content, "stage_alone", lambda build, label: written.append(label) or alone(build, label))
    in_rounds = content.content_scores(pairs, profiles, features, 4)
    assert _sorted(in_rounds) == at_once and len(at_once) == pairs.count()
    assert written == ["content_scores"] * 4


def test_profiles_in_rounds(spark):
    """Every user stands in one round, and a round reads the ratings of its users only."""
    train, features, _ = _tables(spark)
    profiles = content.user_profiles(train, features)
    parts = []

    def round_(share):
        parts.append({r.id for r in share(profiles, "id").select("id").distinct().collect()})
        plan = share(profiles, "id")._jdf.queryExecution().optimizedPlan().toString()
        below_shuffle = plan.split("RepartitionByExpression")[1]
        assert "pmod(xxhash64(7, userId" in below_shuffle
        return share(profiles, "id")

    found = content.in_rounds(3, round_, "profiles")
    assert _sorted(found.select("id", "feature", F.round("weight", 9))) == _sorted(profiles.select("id", "feature", F.round("weight", 9)))
    users = profiles.select("id").distinct().count()
    assert len(parts) == 3 and sum(map(len, parts)) == len(set().union(*parts)) == users > 20


def test_rounds_follow_the_entries_that_travel(spark):
    train, features, pairs = _tables(spark)
    sizes = {r.id: r.n for r in features.groupBy("id").agg(F.count("*").alias("n")).collect()}
    few = BlockPlan(shipped=1)
    rated, listed = ([r.movieId for r in df.collect()] for df in (train, pairs))
    for movies, more in ((rated, None), (rated + listed, pairs)):
        entries = sum(sizes.get(m, 0) for m in movies)
        assert content.profile_rounds(train, features, more, few) == -(-entries // (4 * len(movies))) > 1
    assert content.profile_rounds(train, features, pairs) == content.profile_rounds(train.limit(0), features, None, few) == 1
