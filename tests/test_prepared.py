"""Hand-made cases of preparation, warehouse and cube operators."""

import re

import pytest
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators import cleaning, content, factor, neighbours, olap, warehouse
from ratingmill.plans import all_queries
from ratingmill.sources import sinks
from ratingmill.sources import tables as T

FOLDER = "/root/testdata/sf0.001"


def test_printed_lists_with_quotes(spark):
    rows = [("""["Children's", 'Comedy']""",), ("""['O"x','B']""",), ("A|B",), ("[]",), (None,), ("[broken",)]
    got = spark.createDataFrame(rows, "t string").select(S.parse_list_text(F.col("t"))).collect()
    assert [r[0] for r in got] == [["Children's", "Comedy"], ['O"x', "B"], ["A", "B"], [], [], []]


def test_repeated_updates_leave_one_row_per_key(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    updates = spark.createDataFrame([(1, "a"), (1, "c"), (3, None), (3, "b")], "k int, v string")
    assert sorted(sinks.upsert(target, updates, ["k"]).collect()) == [(1, "c"), (2, "old"), (3, "b")]
    assert sorted(sinks.upsert(target, updates, ["k"], ["v"]).collect(), key=repr) == [(1, "a"), (2, "old"), (3, None)]


def test_first_per_key_over_two_keys(spark):
    rows = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 6, "x"), (2, 5, None)], "userId int, movieId int, tag string")
    got = cleaning.first_per_key(rows, ["userId", "movieId"], ["tag"]).collect()
    assert sorted(got, key=repr) == [(1, 5, "x"), (1, 6, "x"), (2, 5, None)]


def test_repeated_metadata_changes_no_count(spark):
    ratings, movies = T.ratings(spark, FOLDER), T.movies(spark, FOLDER)
    links, metadata = T.links(spark, FOLDER), T.metadata(spark, FOLDER)
    once = warehouse.build_cube(ratings, movies, links, metadata)
    twice = warehouse.build_cube(ratings, movies, links.union(links), metadata.union(metadata))
    assert olap.rollup(twice).collect() == olap.rollup(once).collect()
    assert twice["movie"].count() == movies.count()
    assert cleaning.raw_movies(movies, links.union(links), metadata.union(metadata)).count() == movies.count()
    assert content.combined_text(movies, metadata.union(metadata)).count() == movies.count()


def test_roll_up_reads_each_table_once(spark):
    plan = all_queries()["olap_rollup"].run(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Relation ", plan)) == 3 and "doc_id" not in plan


def test_fact_ids_are_unique(spark):
    facts = all_queries()["fact_rating"].run(spark, FOLDER)
    n = facts.count()
    assert {r[0] for r in facts.select("fact_id").collect()} == set(range(1, n + 1))


def test_neighbours_of_some_users_only(spark):
    centred = neighbours.centred_train(T.ratings(spark, FOLDER).limit(2000))
    users = centred.select("userId").distinct().filter("userId % 3 = 0")
    some = neighbours.user_neighbours(centred, users=users).collect()
    every = neighbours.user_neighbours(centred).filter("userId % 3 = 0").collect()
    assert sorted(some) == sorted(every)


def test_dense_rows(spark):
    rows = spark.createDataFrame([(7, 2, 0.5), (7, 4, 1.5), (8, 5, 2.0), (9, 1, 1.0)], "id bigint, feature int, weight double")
    got = {r["movieId"]: r["features"] for r in content.dense_features(rows).collect()}
    assert got == {7: [0.0, 0.5, 0.0, 1.5, 0.0], 8: [0.0, 0.0, 0.0, 0.0, 2.0], 9: [1.0, 0.0, 0.0, 0.0, 0.0]}
    assert [r["movieId"] for r in content.dense_features(rows, 1).collect()] == [7]


def test_factors_beat_the_biases_and_ignore_the_partitioning(spark):
    """Ratings with structure: two groups of users with opposite taste."""
    rows = [(u, m, 4.5 if (u + m) % 2 else 1.5, 0) for u in range(60) for m in range(40) if (u * 7 + m * 3) % 5]
    held = [(u, m, 4.5 if (u + m) % 2 else 1.5) for u in range(60) for m in range(40) if not (u * 7 + m * 3) % 5]
    train = spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double, timestamp bigint")
    test = spark.createDataFrame(held, "userId bigint, movieId bigint, rating double")
    settings = {"rank": 4, "maxIter": 5, "blocks": 3}
    one, two = (factor.BiasedFactors(**settings).fit(train.repartition(n)).transform(test) for n in (2, 7))
    got = [{(r["userId"], r["movieId"]): r["prediction"] for r in df.collect()} for df in (one, two)]
    assert got[0].keys() == got[1].keys()
    assert all(got[0][k] == pytest.approx(got[1][k], abs=1e-4) for k in got[0])
    error = lambda df, c: df.agg(F.sqrt(F.avg((F.col("rating") - F.col(c)) ** 2))).first()[0]
    assert error(one, "prediction") < 0.5 * error(factor.baseline_scores(test, *factor.biases(train)), "cf_score")
