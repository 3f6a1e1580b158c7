"""Repeated substrings: removal of every byte in a string of ``match`` bytes that also starts anywhere else.

A suffix array of the whole corpus would sort a suffix per byte. Here only starts that can have a partner are sorted.

1. Every window of ``match`` bytes has an anchor, the first of its smallest-hashed substrings of half that length; equal
   windows have equal anchors at equal offsets. Anchors whose substring hash occurs once in the corpus end here.
2. The starts of a remaining anchor are cut into pieces, a sixth of the window long, by their distance from it. All windows of
   a piece share a core, five sixths of a window. Pieces are counted by (core, whole piece): of equal pieces every start
   has a partner, and one of them stands for all.
3. Different pieces with one core are settled by their suffixes: deep-shallow sorting brings equal windows
   together. A core with more than ``HOT`` different pieces is too much for a task; its windows are counted by a
   128-bit hash instead, with a partial count before the shuffle.

Matches never cross documents, overlaps count, and windows are judged on the input. Texts are UTF-8 bytes. Texts are shuffled
twice, to the remaining anchors and to the spans found, and travel compressed.

Defined cases: null text is empty; texts shorter than ``match`` lose nothing; a row repeated whole is another occurrence, so
its repeats match each other; an empty table gives an empty result; extra columns are not read.
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
from ratingmill.llm.line_dedup import identified, narrowed
from ratingmill.llm.suffix_sort import suffix_order
from ratingmill.session import stage

MATCH = 400
HOT = 5000
PACK_PIECES = 4000
KEY = ["_id", "text_id"]
CHUNK = 1 << 18  # text bytes whose hashes a task holds at once
_UNPACK_ROWS = 256
_LOW = (1 << 32) - 1


def piece_starts(match: int) -> int:
    return match // 6 + 1


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def anchors(data: np.ndarray, at: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows inside a text, the anchor of each, and the hash of the substring at every position."""
    gram = match // 2
    if len(data) < match:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    sums = W.prefix_sums(data)
    where = np.arange(len(data) - gram + 1)
    hashes = W.span_hashes(sums, where, where + gram)
    # The hash decides by its upper half; of equal ones the first position wins.
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | where.astype(np.uint64)
    first = (_sliding_least(ranked, match - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int32)
    low, high = at[:-1], at[1:] - match + 1
    some = high > low
    np.add.at(inside, low[some], 1)
    np.add.at(inside, high[some], -1)
    starts = np.flatnonzero(np.cumsum(inside[: len(first)]))
    return starts, first[starts], hashes


def _grams(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in identified(batches):
            for rows, data, at in W.chunks(batch, limit=CHUNK):
                starts, first, hashes = anchors(data, at, match)
                new = np.ones(len(first), bool)
                new[1:] = first[1:] != first[:-1]
                own = first[new]
                begin = np.searchsorted(own, at).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(begin), pa.array(W.signed(hashes[own])))
                yield pa.RecordBatch.from_arrays([rows.column("_id"), rows.column("text_id"), grams], [*KEY, "grams"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in identified(batches):
        packed = pa.array([zlib.compress(t, 1) for t in batch.column("text").cast(pa.binary()).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "doc_id")), packed], [*KEY, "doc_id", "packed"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Few rows at a time with their texts."""
    for batch in batches:
        for low in range(0, batch.num_rows, _UNPACK_ROWS):
            rows = batch.slice(low, _UNPACK_ROWS)
            yield rows, [zlib.decompress(p) for p in rows.column("packed").to_pylist()]


def _text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for rows, texts in _unpacked(batches):
        names = [*rows.schema.names, "text"]
        yield from W.chunks(pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], names), limit=CHUNK)


def _pieces(match: int):
    """core, whole, row and span (first start in the text, shifted, and last) of the pieces at the wanted anchors."""
    size = piece_starts(match)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in _text_chunks(batches):
            starts, first, hashes = anchors(data, at, match)
            text = np.searchsorted(at, starts, "right") - 1
            # A wanted hash may belong to another text of the chunk: then its anchor is wanted there too.
            wanted = np.unique(rows.column("grams").flatten().to_numpy()).view(np.uint64)
            use = np.isin(hashes[first], wanted)
            starts, first, text = starts[use], first[use], text[use]
            block = (first - starts) // size
            new = np.ones(len(starts), bool)
            new[1:] = (first[1:] != first[:-1]) | (block[1:] != block[:-1]) | (starts[1:] != starts[:-1] + 1)
            lo = starts[new]
            hi = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)] if len(lo) else lo
            first, block, text = first[new], block[new], text[new]
            sums = W.prefix_sums(data)
            last = first - block * size
            core = W.mixed(W.span_hashes(sums, last, last - size + 1 + match) ^ block.astype(np.uint64))
            whole = W.mixed(W.span_hashes(sums, lo, hi + match) ^ (first - lo).astype(np.uint64))
            span = ((lo - at[text]) << 32) | (hi - at[text])
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(core)), pa.array(W.signed(whole)), rows.column("row").take(pa.array(text)), pa.array(span)],
                ["core", "whole", "row", "span"],
            )

    return run


def _piece_bytes(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _unpacked(batches):
            out: list[tuple] = []
            for text, row, pieces in zip(texts, *(rows.column(c).to_pylist() for c in ("row", "pieces"))):
                for p in pieces:
                    lo, hi = p["span"] >> 32, p["span"] & _LOW
                    out.append((p["core"], row, lo, text[lo : hi + match]))
            kinds = [pa.int64()] * 3 + [pa.binary()]
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["core", "row", "lo", "bytes"])

    return run


def _window_hashes(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in _text_chunks(batches):
            sums = [W.prefix_sums(data, k) for k in (0, 1)]
            for base, row, pieces in zip(at.tolist(), *(rows.column(c).to_pylist() for c in ("row", "pieces"))):
                lo = np.concatenate([np.arange(p["span"] >> 32, (p["span"] & _LOW) + 1) for p in pieces])
                h = [W.signed(W.span_hashes(sums[k], base + lo, base + lo + match, k)) for k in (0, 1)]
                columns = [pa.array(h[0]), pa.array(h[1]), pa.array(np.full(len(lo), row)), pa.array((lo << 32) | lo)]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "row", "span"])

    return run


def _sorted(match: int):
    """Spans of starts that have an equal window among the pieces of their core."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        pieces = rows["bytes"].to_pylist()
        lengths = np.array([len(p) for p in pieces])
        base = np.cumsum(lengths) - lengths
        n = lengths - match + 1
        piece = np.repeat(np.arange(len(pieces)), n)
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        order, same = suffix_order(np.frombuffer(b"".join(pieces), np.uint8), base[piece] + shift, match)
        hit = np.zeros(len(order), bool)
        hit[order[same]] = True
        hit[order[np.flatnonzero(same) - 1]] = True
        at = np.flatnonzero(hit)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (piece[at][1:] != piece[at][:-1])
        first = at[new]
        last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
        lo, own = rows["lo"].to_numpy(), piece[first]
        span = ((lo[own] + shift[first]) << 32) | (lo[own] + shift[last])
        return pa.table({"row": rows["row"].to_numpy()[own], "span": span})

    return run


def repeated_spans(src: DataFrame, packed: DataFrame, match: int = MATCH, hot: int = HOT, pack: int = PACK_PIECES) -> DataFrame:
    """_id, text_id, spans of ``src`` (see ``narrowed``): first (shifted by 32 bits) and last starts of repeated windows of each text that has any."""
    grams = src.select("_id", "text").mapInArrow(_grams(match), "_id bigint, text_id bigint, grams array<bigint>")
    grams = stage(grams.withColumn("row", F.monotonically_increasing_id()), "grams")
    each = grams.select("row", F.explode("grams").alias("gram"))
    again = stage(each.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "again")
    total = grams.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]
    # A substring that very many texts hold is not sent to one task.
    wanted = join_counted(each, again, ["gram"], total).groupBy("row").agg(F.collect_set("gram").alias("grams"))
    # Rows that repeat a text share its row number, and stay as many.
    names = grams.groupBy(*KEY).agg(F.min("row").alias("row"))
    wanted = stage(wanted.join(names, "row"), "wanted")
    some = stage(packed.select(*KEY, "packed").join(wanted, KEY).select("row", "packed", "grams"), "texts")
    pieces = stage(some.mapInArrow(_pieces(match), "core bigint, whole bigint, row bigint, span bigint"), "pieces")
    # One member stands for equal pieces: the first row with one of its spans.
    classes = pieces.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("span", "row").alias("span"))
    classes = stage(classes, "classes")
    found = pieces.join(classes.filter("n > 1").select("core", "whole"), ["core", "whole"]).select("row", "span")
    kinds = classes.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    rivals = stage(classes.join(kinds, "core").select("core", "row", "span", "kinds"), "rivals")

    def by_text(chosen: DataFrame) -> DataFrame:
        return some.select("row", "packed").join(chosen.groupBy("row").agg(F.collect_list(F.struct("core", "span")).alias("pieces")), "row")

    packs = max(1, -(-rivals.count() // pack))
    cut = by_text(rivals.filter(F.col("kinds") <= hot)).mapInArrow(_piece_bytes(match), "core bigint, row bigint, lo bigint, bytes binary")
    by_core = cut.withColumn("_pack", F.pmod(F.xxhash64("core"), F.lit(packs))).groupBy("_pack")
    found = found.unionByName(by_core.applyInArrow(_sorted(match), "row bigint, span bigint"))
    windows = by_text(rivals.filter(F.col("kinds") > hot)).mapInArrow(_window_hashes(match), "h1 bigint, h2 bigint, row bigint, span bigint")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2")
    found = found.unionByName(windows.join(twice, ["h1", "h2"]).select("row", "span"))
    return found.groupBy("row").agg(F.collect_list("span").alias("spans")).join(wanted.select("row", *KEY), "row").drop("row")


def _cut_out(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _unpacked(batches):
            kept, totals, removed, spans = [], [], [], []
            for text, found in zip(texts, rows.column("spans").to_pylist()):
                totals.append(len(text))
                parts, at, gone, runs = [], 0, 0, 0
                end = -1
                for low, high in sorted((s >> 32, (s & _LOW) + match) for s in found or ()):
                    if low > end:
                        runs += 1
                        parts.append(text[at:low])
                        gone += high - low
                    elif high > end:
                        gone += high - end
                    end = at = max(end, high)
                parts.append(text[at:])
                kept.append(b"".join(parts))
                removed.append(gone)
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in (totals, removed, spans)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, match: int = MATCH, hot: int = HOT, pack: int = PACK_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes): one row per row of ``docs``.

    Cuts may fall inside a character, so the rest is bytes.
    """
    # Text ids are formed in the step that needs them: a step of their own is a second Python worker per task, with its own copy of each batch.
    src = narrowed(docs)
    packed = src.mapInArrow(_packed, "_id bigint, text_id bigint, doc_id bigint, packed binary")
    spans = repeated_spans(src, packed, match, hot, pack)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return packed.join(spans, KEY, "left").mapInArrow(_cut_out(match), schema)
