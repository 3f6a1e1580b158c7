from pyspark.sql import Window
from pyspark.sql import functions as F

from ratingmill.operators.ranking import top_per_group, with_group_rank, with_position
from ratingmill.operators.splitting import split_global, split_per_user


def _ratings(spark, n=3000):
    # User 1 holds a third of all rows and every user repeats timestamps.
    user = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 37 + 2).cast("bigint")
    return spark.range(n).select(
        user.alias("userId"),
        F.col("id").alias("movieId"),
        ((F.col("id") % 10 + 1) / 2).alias("rating"),
        (F.xxhash64("id") % 5).alias("timestamp"),
    )


def test_position_is_the_global_order(spark):
    df = _ratings(spark)
    got = with_position(df, [F.desc("timestamp"), "userId", "movieId"]).collect()
    assert sorted(r.position for r in got) == list(range(1, 3001))
    order = sorted(got, key=lambda r: (-r.timestamp, r.userId, r.movieId))
    assert [r.position for r in order] == list(range(1, 3001))


def test_hot_groups_are_ranked_as_by_a_window(spark):
    df = _ratings(spark)
    columns = ["userId", "movieId", "rank", "count"]
    plain = with_group_rank(df, "userId", ["timestamp", "movieId"]).select(columns).collect()
    ranged = with_group_rank(df, "userId", ["timestamp", "movieId"], hot_rows=100).select(columns).collect()
    assert sorted(plain) == sorted(ranged)
    window = Window.partitionBy("userId").orderBy("timestamp", "movieId")
    want = df.select("userId", "movieId", F.row_number().over(window).alias("rank")).collect()
    assert sorted((r.userId, r.movieId, r.rank) for r in plain) == sorted(tuple(r) for r in want)


def test_split_covers_everything_once_and_respects_time(spark):
    df = _ratings(spark)
    rows = split_per_user(df, hot_rows=100).collect()
    assert sorted((r.userId, r.movieId) for r in rows) == sorted((r.userId, r.movieId) for r in df.collect())
    users = {}
    for r in rows:
        users.setdefault(r.userId, []).append(r)
    for mine in users.values():
        train = [r for r in mine if r.is_train]
        assert len(train) == len(mine) * 4 // 5
        if train and len(train) < len(mine):
            assert max((r.timestamp, r.movieId) for r in train) < min((r.timestamp, r.movieId) for r in mine if not r.is_train)


def test_global_split_takes_the_oldest_rows(spark):
    rows = split_global(_ratings(spark, 101)).collect()
    ordered = sorted(rows, key=lambda r: (r.timestamp, r.userId, r.movieId))
    assert [r.is_train for r in ordered] == [True] * 80 + [False] * 21


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = top_per_group(_ratings(spark), "userId", [F.desc("rating"), "movieId"], 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert df.filter("userId = 1").count() == 4
