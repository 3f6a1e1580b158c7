"""Target-distribution importance resampling with hashed word n-grams.

Words come from one table: bytes.translate lower-cases A-Z and blanks every ASCII byte that is neither letter nor digit, and
bytes.split cuts. All bytes of other UTF-8 characters are word bytes. A feature is a run of 1 to ``GRAM`` consecutive words joined
by one space; its crc32 is chained: the value of a run is the seed for the run one word longer, so each word is hashed once per
length and no run is ever built as a string. The bucket is the crc32 modulo ``BUCKETS``.

1. Each task keeps one Counter of buckets, at most ``BUCKETS`` entries, and emits it at its end; Spark adds the Counters of the raw
   and of the target texts.
2. The gain of a bucket, the floor of 1000 times the log ratio of its smoothed shares, is computed in SQL over the ``BUCKETS``
   rows, which are all that ever reaches the driver.
3. The weight of a text is the sum of the gains of its features. A Gumbel key from a hash of doc_id is added, and the highest sums
   of the eligible texts are drawn: positions come from a range-partitioned sort, so the drawn share may be of any size.

A long text is cut into slices at separators; the last words of a slice are carried, so no feature is lost and memory is bounded
by the text and one slice of its words.

Defined cases: null and empty texts have no features and weight 0 and are never drawn while ``min_words`` is above 0; a null doc_id
is hashed as an empty one and loses ties; rows that repeat a doc_id share the key, tie by text hash, and each may be drawn; empty
tables give empty results, an empty target makes all shares of the target equal; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.operators.ranking import with_position
from ratingmill.session import stage

BUCKETS = 10_000
GRAM = 3
MIN_WORDS = 20
SHARE = (5, 100)
SEED = 42
_SLICE = 1 << 20

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_slices(text: bytes, size: int = _SLICE) -> Iterator[list[bytes]]:
    """The words of a text, about ``size`` bytes of it at a time."""
    clean = text.translate(_TABLE)
    low = 0
    while low < len(clean):
        cut = clean.find(b" ", low + size)
        high = len(clean) if cut < 0 else cut
        yield clean[low:high].split()
        low = high


def feature_hashes(slices: Iterator[list[bytes]], gram: int = GRAM) -> Iterator[tuple[int, list[int]]]:
    """Number of words and crc32 of all features of each slice; runs that end in a slice are its own."""
    carried: list[bytes] = []
    for words in slices:
        both = carried + words
        spaced = [b" " + w for w in both]
        run = list(map(crc32, both))
        found = run[len(carried) :]
        for length in range(1, gram):
            run = list(map(crc32, spaced[length:], run))
            found += run[max(0, len(carried) - length) :]
        yield len(words), found
        carried = both[1 - gram :] if gram > 1 else []


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _bucket_counts(buckets: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in _texts(batch):
                for _, hashes in feature_hashes(word_slices(text), gram):
                    counts.update((np.array(hashes, np.uint32) % np.uint32(buckets)).tolist())
        keys, values = pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())
        yield pa.RecordBatch.from_arrays([keys, values], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, gram: int = GRAM) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that any falls into."""
    partial = texts.select("text").mapInArrow(_bucket_counts(buckets, gram), "bucket bigint, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS, gram: int = GRAM) -> DataFrame:
    """bucket, gain for every bucket, also those without a feature."""
    spark = raw.sparkSession
    s = bucket_counts(raw, buckets, gram).withColumnRenamed("n", "s")
    t = bucket_counts(target, buckets, gram).withColumnRenamed("n", "t")
    # One row per bucket: the counts are bounded by ``buckets`` whatever the corpus.
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0)
    every = stage(every, "buckets")
    all_s, all_t = (float(x) for x in every.agg(F.sum("s"), F.sum("t")).first())

    def smoothed(name: str) -> Column:
        return F.col(name).cast("double") + 1.0

    ratio = smoothed("t") * (all_s + buckets) / (smoothed("s") * (all_t + buckets))
    return every.select("bucket", F.floor(F.ln(ratio) * 1000.0).cast("bigint").alias("gain"))


def _weights(gains: np.ndarray, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch):
                words = features = weight = 0
                for n, hashes in feature_hashes(word_slices(text), gram):
                    words += n
                    features += len(hashes)
                    weight += int(gains[np.array(hashes, np.uint32) % np.uint32(len(gains))].sum())
                rows.append((words, features, weight, crc32(text)))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "n_features", "weight", "text_crc"]
            )

    return run


def importance_weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_features, weight, text_crc: one row per row of ``docs``."""
    gains = np.zeros(buckets, np.int64)
    for bucket, gain in bucket_gains(docs, target, buckets, gram).toArrow().to_pandas().itertuples(index=False):
        gains[bucket] = gain
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_weights(gains, gram), "doc_id bigint, n_words bigint, n_features bigint, weight bigint, text_crc bigint")


def gumbel_key(seed: int = SEED) -> Column:
    """A Gumbel variate per doc_id, in thousandths, from the first 32 bits of a SHA-256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.ln(-F.ln((h + 0.5) / 4294967296.0)) * -1000.0).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    gram: int = GRAM,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank; rank is null for rows that are not drawn.

    Of the rows with ``min_words`` words the share ``share`` (floored) with the highest scores is drawn.
    """
    scored = importance_weights(docs, target, buckets, gram).withColumn("score", F.col("weight") + gumbel_key(seed))
    scored = stage(scored, "scored")
    eligible = F.col("n_words") >= min_words
    drawn = scored.filter(eligible).count() * share[0] // share[1]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "text_crc"]
    placed = with_position(scored.filter(eligible), order, "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rest = scored.filter(~eligible).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*columns, rank).unionByName(rest)
