"""Incrementally kept tables: which files an upsert writes, what readers see, failed and rival writers."""

import os

import pytest
from pyspark.sql import functions as F

from ratingmill.operators.quantiles import order_statistics, quantile
from ratingmill.sources.buckets import BucketTable, ManifestConflict


def _table(spark, tmp_path, rows, buckets=16):
    table = BucketTable(spark, f"file://{tmp_path}/t")
    table.create(spark.createDataFrame(rows, "id bigint, name string"), ["id"], buckets)
    return table


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _files(tmp_path):
    return {os.path.join(d, f) for d, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")}


def test_an_upsert_writes_the_touched_buckets_only(spark, tmp_path):
    table = _table(spark, tmp_path, [(i, "old") for i in range(400)])
    before, old = _files(tmp_path), table.manifest()
    updates = [(7, "new"), (7, "newer"), (1000, "added")]
    touched = table.upsert(spark.createDataFrame(updates, "id bigint, name string"))
    assert 1 <= len(touched) <= 2
    new = table.manifest()
    assert {b for b in new["folders"] if new["folders"][b] != old["folders"].get(b)} == {str(b) for b in touched}
    assert before <= _files(tmp_path) and len(_files(tmp_path) - before) == len(touched)
    want = {i: "old" for i in range(400)} | {7: "newer", 1000: "added"}
    assert _rows(table.read()) == sorted(want.items())
    assert _rows(table.read(1)) == [(i, "old") for i in range(400)]
    assert table.add_missing(spark.createDataFrame([(7, "x"), (2000, "late")], "id bigint, name string"))
    assert _rows(table.read()) == sorted((want | {2000: "late"}).items())


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    table = _table(spark, tmp_path, [(i, "old") for i in range(50)])
    bad = spark.createDataFrame([(3, "new")], "id bigint, name string").withColumn(
        "name", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("name"))
    )
    with pytest.raises(Exception, match="broken"):
        table.upsert(bad)
    with pytest.raises(ValueError, match="not those of the table"):
        table.upsert(spark.createDataFrame([(3, 4)], "id bigint, other int"))
    assert table.versions() == [1] and _rows(table.read()) == [(i, "old") for i in range(50)]


def test_rival_writers_and_empty_updates(spark, tmp_path):
    table = _table(spark, tmp_path, [])
    assert _rows(table.read()) == []
    assert table.upsert(spark.createDataFrame([], "id bigint, name string")) == [] and table.versions() == [1]
    assert table.upsert(spark.createDataFrame([(None, "null key")], "id bigint, name string"))
    with pytest.raises(ManifestConflict):
        table._publish(table.manifest(), 2)
    assert table.versions() == [1, 2] and _rows(table.read()) == [(None, "null key")]


@pytest.mark.parametrize("few", [1, 10, 1000])
def test_quantiles_by_refinement(spark, few):
    values = [0.0, 0.0, -1.5, 1e9, 1e9 + 1, 3.25, None] + [i / 7 for i in range(200)] + [5.0] * 300
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    at = [0, 1, 77, 250, len(known) - 2, len(known) - 1]
    assert order_statistics(df, "v", at, bins=8, few=few) == {p: known[p] for p in at}
    middle = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    assert abs(quantile(df, "v", 0.5, bins=8, few=few) - middle) < 1e-12
    assert quantile(df.filter("v > 1e10"), "v", 0.5) is None
