"""What must not grow: shuffle files left behind, shuffles of profiles."""

import time

from pyspark.sql import functions as F

from ratingmill.operators import content
from ratingmill.operators.factor import BiasedFactors
from ratingmill.operators.vectors import packed, weighted_sums
from ratingmill.session import stage


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left_behind(spark, before, most):
    """Shuffle files made since ``before``, once they are ``most`` at most or ten seconds are over: removal is asynchronous."""
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if len(left) <= most:
            break
        time.sleep(0.2)
    return left


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert stage(rows, "grouped").agg(F.sum("n")).first()[0] == 1000
    # The sum after it has one task per file and is not staged; the grouping had 8 tasks and more.
    assert len(_left_behind(spark, before, 16)) <= 16
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_stage_twice_gives_the_same(spark):
    rows = spark.range(100).repartition(4).groupBy((F.col("id") % 3).alias("k")).agg(F.sum("id").alias("n"))
    first, second = stage(rows, "a"), stage(rows, "b")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect())) == sorted(map(tuple, rows.collect()))


def test_factor_fit_leaves_no_files_of_earlier_iterations(spark):
    rows = spark.range(400).select((F.col("id") % 20).alias("userId"), (F.col("id") % 21).alias("movieId"), (F.col("id") % 5 + 1.0).alias("rating"))
    made = []
    for steps in (2, 9):
        before = _shuffle_files(spark)
        BiasedFactors(rank=2, maxIter=steps, blocks=2).fit(rows)
        made.append(len(_left_behind(spark, before, made[0] if made else 0)))
    assert made[1] <= made[0] + 4


def _features(spark):
    rows = [(1, 1, 1.0), (1, 3, 0.5), (2, 2, 2.0), (3, 1, 1.5), (3, 2, 0.25), (3, 3, 1.0)]
    return spark.createDataFrame(rows, "id bigint, feature bigint, weight double")


def test_profiles_are_grouped_without_another_shuffle(spark):
    rated = spark.createDataFrame([(7, 1, 4.0), (7, 3, 2.0), (8, 2, 1.0), (8, 9, 5.0), (None, 1, 3.0)], "owner bigint, id bigint, rating double")
    sums = weighted_sums(rated, packed(_features(spark)))
    found = {(r["owner"], r["feature"]): r["weight"] for r in sums.collect()}
    assert found == {(7, 1): 7.0, (7, 2): 0.5, (7, 3): 4.0, (8, 2): 2.0, (None, 1): 3.0, (None, 3): 1.5}
    again = sums.groupBy("owner").agg(F.count("*"))
    assert _plan(again).count("Exchange hashpartitioning") == _plan(sums.select("*")).count("Exchange hashpartitioning")


def test_content_scores_by_hand(spark):
    train = spark.createDataFrame([(7, 1, 4.0), (7, 3, 2.0)], "userId bigint, movieId bigint, rating double")
    pairs = spark.createDataFrame([(7, 2), (7, 2), (7, 9), (8, 1)], "userId bigint, movieId bigint")
    features = _features(spark)
    scored = content.content_scores(pairs, content.user_profiles(train, features), features)
    # Profile 7: (7, 0.5, 4) / 6; movie 2 has feature 2 only.
    cosine = 0.5 / (49 + 0.25 + 16) ** 0.5
    near = max(0.5, round(5 * cosine, 6))
    assert sorted(map(tuple, scored.collect())) == [(7, 2, near), (7, 2, near), (7, 9, 2.5), (8, 1, 2.5)]
