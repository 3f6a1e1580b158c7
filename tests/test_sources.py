import pytest
from pyspark.sql import functions as F

from ratingmill.operators import cleaning, quality, warehouse
from ratingmill.session import fresh_path
from ratingmill.sources import readers, schemas, sinks


def test_absent_source_is_empty_with_declared_columns(spark):
    df = readers.read_optional_csv(spark, fresh_path(spark, "nothing.csv"), schemas.TAGS)
    assert df.columns == ["userId", "movieId", "tag", "timestamp"] and df.count() == 0


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="rating, timestamp"):
        readers.require_columns(spark.createDataFrame([], "userId long, movieId long"), schemas.REQUIRED["ratings"], "train")


def test_csv_keeps_quotes_and_line_breaks(spark):
    path = fresh_path(spark, "meta")
    rows = [(1, 'He said "hi", then\nleft', "A|B", None, "", "en")]
    sinks.write_csv(spark.createDataFrame(rows, schemas.METADATA), path)
    back = readers.read_csv(spark, path, schemas.METADATA, multi_line=True).first()
    assert back.overview == rows[0][1] and back.cast == "A|B" and back.director is None


def test_payload_defaults(spark):
    rows = [
        (1, '{"overview": null, "credits": {"cast": [{"name": "A"}, {"name": null}], "crew": [{"job": "Writer", "name": "W"}]}}'),
        (2, '{"poster_path": "/p.jpg", "credits": {"crew": [{"job": "Director", "name": "D1"}, {"job": "Director", "name": "D2"}]}}'),
        (3, "not json"),
    ]
    got = {r.movieId: r for r in readers.payload_metadata(spark.createDataFrame(rows, "movieId long, payload string")).collect()}
    assert (got[1].overview, got[1].cast, got[1].director, got[1].poster_url) == ("", "A|", "Unknown", "")
    assert (got[2].director, got[2].poster_url) == ("D1", readers.POSTER_PREFIX + "/p.jpg")
    assert (got[3].cast, got[3].director, got[3].original_language) == ("", "Unknown", "")


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(map(tuple, sinks.upsert(target, updates, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_null_defaults_and_title_search(spark):
    df = spark.createDataFrame([(1, None, None, None, None, "en")], schemas.METADATA)
    row = cleaning.fill_metadata(df).first()
    assert (row.overview, row.cast, row.director, row.poster_url) == ("", "Unknown", "Unknown Director", "")
    movies = spark.createDataFrame([(2, "Batman (1989)"), (1, None), (3, "The BATMAN")], "movieId long, title string")
    assert [r.movieId for r in cleaning.search_titles(movies, "batm.n").collect()] == [2, 3]


def test_orphans_are_counted(spark):
    star = {
        "dim_user": spark.createDataFrame([(1,)], "user_id long"),
        "dim_movie": spark.createDataFrame([(1,)], "movie_id long"),
        "dim_time": spark.createDataFrame([(1,)], "time_id long"),
        "fact_rating": spark.createDataFrame([(1, 1, 1), (2, 1, 9), (1, 7, 1)], "user_id long, movie_id long, time_id long"),
    }
    assert {r.foreign_key: r.orphans for r in quality.orphan_counts(star).collect()} == {"user_id": 1, "movie_id": 1, "time_id": 1}


def test_fact_gives_null_or_default_for_users_without_training(spark):
    split = spark.createDataFrame([(1, 1, 4.0, 0, True), (1, 2, 2.0, 86400, False), (2, 1, 3.0, 0, False)], "userId long, movieId long, rating double, timestamp long, is_train boolean")
    times = warehouse.dim_time(split)
    assert {r.user_id: r.normalized_rating for r in warehouse.fact_rating(split, times).filter("not is_train").collect()} == {1: -2.0, 2: 3.0}
    strict = warehouse.fact_rating(split, times, default_mean=None).filter(F.col("user_id") == 2).first()
    assert strict.normalized_rating is None
    assert warehouse.fact_rating(split, times).select("fact_id").distinct().count() == 3
