"""Substring dedup by seed and extend: removal of passages of ``window`` words that a document with a smaller doc_id holds too.

1. Seeds. Every window of words has an anchor, the first of its smallest-hashed runs of half that length; equal windows have equal
   anchors at equal offsets (winnowing). The windows that chose one anchor are consecutive starts.
2. Join. Documents meet on their anchors. No pair of documents is formed: an anchor is extended both ways as far as its windows
   reach, and occurrences with the same extension are one class, known by its first document. Occurrences in later documents
   match that first one over the whole extension.
3. Extend. Anchors with several classes are extended step by step: one start for each number of words to the left, the rest of the
   window to the right. Each extended match is known by 128 bits and its first document. Only the occurrences in the first document of a class
   are extended so, as all later ones are matched already.
4. Matches of a document are merged into maximal repeats; none is shorter than a window.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are judged on the input. Anchors and classes with very many rows are joined where
they lie (``join_counted``), counts are combined before each shuffle.

Defined cases: null and empty texts have no words; a text shorter than a window loses nothing; rows with equal doc_id are
one document and never match each other; a null doc_id is one document behind all others; an empty table gives an empty result;
extra columns are not read. Hashes of 128 bits are taken as exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.llm import words as W
from ratingmill.llm.hot_keys import join_counted
from ratingmill.llm.line_dedup import text_ids
from ratingmill.session import stage

WINDOW = 50
KEY = ["_id", "text_id"]
_LAST_ID = 2**63 - 1
_UNPACK_ROWS = 256
_LOW = (1 << 32) - 1
_ROLL = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]


class Runs:
    """Hashes of any run of words of a chunk of texts."""

    def __init__(self, data: np.ndarray, at: np.ndarray, which: int = 0):
        starts, ends, self.first = W.word_bounds(data, at)
        words = W.span_hashes(W.prefix_sums(data, which), starts, ends, which)
        base = _ROLL[which]
        powers = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(len(words) + 1, b, np.uint64)
            p[0] = 1
            powers.append(np.multiply.accumulate(p))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[0][:-1], out=self.sums[1:])
        self.back = powers[1]

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return W.mixed((self.sums[high] - self.sums[low]) * self.back[low])


def sliding_first_least(x: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value among each ``width`` neighbours, by doubling; values below are told apart by 32 bits."""
    ranked = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(x), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        ranked = np.minimum(ranked[:-span], ranked[span:])
        span *= 2
    if width > span:
        ranked = np.minimum(ranked[: len(ranked) - (width - span)], ranked[width - span :])
    return (ranked & np.uint64(_LOW)).astype(np.int64)


def seeds(runs: Runs, window: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, extension hash, text, first and last start (in the chunk) of the windows of every anchor occurrence."""
    seed = window // 2
    n = len(runs.sums) - 1
    if n < window:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    low = np.arange(n - seed + 1)
    hashes = runs(low, low + seed)
    anchor = sliding_first_least(hashes, window - seed + 1)
    begin, end = runs.first[:-1], runs.first[1:] - window + 1
    some = end > begin
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, begin[some], 1)
    np.add.at(inside, end[some], -1)
    starts = np.flatnonzero(np.cumsum(inside[: len(anchor)]))
    own = anchor[starts]
    text = np.searchsorted(runs.first, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    lo = starts[new]
    hi = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)] if len(lo) else lo
    own = own[new]
    # The extension is the text of all its windows and where the anchor lies in it.
    whole = W.mixed(runs(lo, hi + window) ^ (own - lo).astype(np.uint64) ^ ((hi - lo).astype(np.uint64) << np.uint64(32)))
    return hashes[own], whole, text[new], lo, hi


def _seeds(window: int):
    names = ["seed", "whole", *KEY, "span"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in W.chunks(batch):
                runs = Runs(data, at)
                seed, whole, text, lo, hi = seeds(runs, window)
                base = runs.first[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(W.signed(seed)),
                        pa.array(W.signed(whole)),
                        rows.column("_id").take(pa.array(text)),
                        pa.array(W.signed(text_ids(data, at))[text]),
                        pa.array(((lo - base) << 32) | (hi - base)),
                    ],
                    names,
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, at in W.chunks(batch):
            packed = [zlib.compress(data[a:b].tobytes(), 1) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [rows.column("_id"), pa.array(W.signed(text_ids(data, at))), rows.column("doc_id"), pa.array(packed, pa.binary())],
                [*KEY, "doc_id", "packed"],
            )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Few rows at a time with their texts."""
    for batch in batches:
        for low in range(0, batch.num_rows, _UNPACK_ROWS):
            rows = batch.slice(low, _UNPACK_ROWS)
            yield rows, [zlib.decompress(p) for p in rows.column("packed").to_pylist()]


def _extended(window: int):
    """h1, h2, _id, text_id, start of every window of the wanted spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _unpacked(batches):
            named = pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], [*rows.schema.names, "text"])
            for part, data, at in W.chunks(named):
                both = [Runs(data, at, k) for k in (0, 1)]
                spans = part.column("spans")
                text = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
                span = spans.flatten().to_numpy()
                lo, hi = span >> 32, span & _LOW
                n = hi - lo + 1
                start = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                text = np.repeat(text, n)
                low = both[0].first[text] + start
                h1, h2 = (W.signed(runs(low, low + window)) for runs in both)
                own = pa.array(text)
                columns = [pa.array(h1), pa.array(h2), *(part.column(c).take(own) for c in KEY), pa.array(start)]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", *KEY, "start"])

    return run


def later_copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key a document with a smaller ``_id`` holds too."""
    rows = stage(rows, "matches")
    first = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    first = stage(first.filter("_first < _last").drop("_last"), "first")
    return join_counted(rows, first, keys, rows.count()).filter(F.col("_id") > F.col("_first"))


def matched_spans(src: DataFrame, packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """_id, text_id, spans: first (shifted by 32 bits) and last word starts of the matched windows of each text that has any.

    ``text_id`` tells apart texts that share a doc_id.
    """
    found = src.select("_id", "text").mapInArrow(_seeds(window), "seed bigint, whole bigint, _id bigint, text_id bigint, span bigint")
    found = stage(found, "seeds")
    classes = found.groupBy("seed", "whole").agg(F.count("*").alias("n"), F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    classes = stage(classes, "classes")
    # Anchors that more than one class has, in different first documents.
    kinds = classes.groupBy("seed").agg(F.count("*").alias("kinds"), F.min("_first").alias("_low"), F.max("_first").alias("_high"))
    kinds = stage(kinds.filter("_low < _high").select("seed", "kinds"), "kinds")
    rivals = join_counted(classes, kinds, ["seed"], classes.count(), "kinds").select("seed", "whole", F.lit(True).alias("rival"))
    wanted = classes.join(rivals, ["seed", "whole"], "left").filter("rival OR _first < _last")
    wanted = stage(wanted.select("seed", "whole", "n", "_first", F.coalesce("rival", F.lit(False)).alias("rival")), "wanted")
    met = stage(join_counted(found, wanted, ["seed", "whole"], found.count()).select(*KEY, "span", "_first", "rival"), "met")
    whole = met.filter(F.col("_id") > F.col("_first")).select(*KEY, "span")
    firsts = met.filter((F.col("_id") == F.col("_first")) & F.col("rival")).groupBy(*KEY).agg(F.collect_set("span").alias("spans"))
    # Rows that repeat a doc_id and its text are extended as often; they never match each other.
    texts = packed.select(*KEY, "packed").join(firsts, KEY)
    steps = texts.mapInArrow(_extended(window), "h1 bigint, h2 bigint, _id bigint, text_id bigint, start bigint")
    step = later_copies(steps, ["h1", "h2"]).select(*KEY, F.expr("(start << 32) | start").alias("span"))
    return whole.unionByName(step).groupBy(*KEY).agg(F.collect_set("span").alias("spans"))


def repeats(spans: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of words under packed spans of window starts: first word and the one after the last."""
    lo, hi = spans >> 32, (spans & _LOW) + window
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    ends = hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)] if len(lo) else hi
    return list(zip(lo[new].tolist(), ends.tolist()))


def _cut_out(window: int):
    names = ["doc_id", "n_words", "n_removed", "repeats", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _unpacked(batches):
            columns: list[list] = [[], [], [], []]
            for text, spans in zip(texts, rows.column("spans")):
                words = text.split()
                runs = repeats(np.asarray(spans.values), window) if spans.is_valid else []
                kept, at = [], 0
                for low, high in runs:
                    kept += words[at:low]
                    at = high
                kept += words[at:]
                values = len(words), len(words) - len(kept), [{"first": a, "end": b} for a, b in runs], b" ".join(kept).decode()
                for column, value in zip(columns, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, repeats (first word and end of each maximal repeat), kept (the other words): one row per row."""
    doc_id, text = F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")
    src = docs.select(F.coalesce(doc_id, F.lit(_LAST_ID)).alias("_id"), doc_id.alias("doc_id"), text)
    packed = src.mapInArrow(_packed, "_id bigint, text_id bigint, doc_id bigint, packed binary")
    spans = matched_spans(src, packed, window)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, repeats array<struct<first: bigint, end: bigint>>, kept string"
    return packed.join(spans, KEY, "left").mapInArrow(_cut_out(window), schema)
