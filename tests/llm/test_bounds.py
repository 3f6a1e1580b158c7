"""What the training-text operators hold, ship and keep."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ratingmill.llm import phrases, quotient_filter, suffix_dedup
from ratingmill.llm import words as W
from ratingmill.session import unstage


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_repeat_removal_holds_little_at_once(spark):
    texts = [f"{i} " + "word soup " * 300 for i in range(1400)]  # 4 MB in one batch
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["_id", "doc_id", "text"])
    for which in (0, 1):
        W.prefix_sums(np.zeros(1, np.uint8), which)  # the powers stay
    tracemalloc.start()
    rows = sum(out.num_rows for out in suffix_dedup._grams(400)(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and most < 60e6


def test_repeat_removal_reads_texts_in_one_python_step(spark):
    # A step before another one in the same task is a second worker with its own copy of each batch.
    found = suffix_dedup.remove_repeats(docs_of(spark, [(1, "a" * 900, "en"), (2, "b", "de")]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow _packed" in plan and "identified(" not in plan


def test_packed_integers_are_small_and_lossless():
    rng = np.random.default_rng(3)
    for kind in (np.uint8, np.int32, np.int64, np.uint64):
        for values in (np.zeros(0, kind), np.zeros(9, kind), rng.integers(0, 200, 1000).astype(kind), np.array([np.iinfo(kind).max, 0, np.iinfo(kind).min], kind)):
            assert quotient_filter.unpack(quotient_filter.pack(values), kind).tolist() == values.tolist()
    # Word numbers: a few are frequent.
    numbers = np.minimum(rng.zipf(1.3, 200_000), 60_000)
    assert len(quotient_filter.pack(numbers)) < 0.75 * len(zlib.compress(numbers.astype(np.int32).tobytes(), 1))


def test_filters_take_fewer_bytes_than_plain_ones():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 30, 20_000).astype(np.uint64))
    counts = np.minimum(rng.zipf(2.0, len(keys)), 5000)
    data = quotient_filter.encode(keys, counts, 30)
    back, again = quotient_filter.decode(data, 30)
    assert (back == keys).all() and (again == counts).all()
    # 30 - 14 remainder bits, and two bytes an entry for slots and counts before.
    assert len(data) < 3 * len(keys)


def test_phrase_mining_deletes_what_it_has_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ratingmill.session.shared_dir", lambda spark: str(tmp_path))
    rows = [(i, "one two three four five, one two", ("en", None)[i % 2]) for i in range(60)]
    got = phrases.collocations(docs_of(spark, rows), 10, 5, 50, chunk_bytes=200, shard_entries=8).collect()
    assert {r["phrase"] for r in got if r["lang"] == "en"} == {"one two three four five", "one two"}
    left = {path.name for path in tmp_path.rglob("*") if path.is_dir()}
    assert "vocabulary" in left and not left & {"chunks", "tokens", "names", "numbers", "state"}


def test_only_staged_tables_are_deleted(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        unstage(spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 3
