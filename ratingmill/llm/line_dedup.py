"""Line deduplication by a range-partitioned, streamed pass over line hashes.

The key of a line is the line without white space (space, 0x09-0x0D) at its ends, A-Z folded. Keys of at least
``MIN_CHARS`` code points that stand in two documents or more are dropped everywhere but in the smallest doc_id that holds
them. Only a 128-bit hash, the document and the position of each such line are shuffled. They are range-partitioned by
(hash, document) and sorted by document and position, so a line that every document holds is spread over
as many tasks as its rows need. A task streams its rows: the first document of a hash keeps its lines. Whether the first
hash of a task began in the task before is known from the two border rows that each task leaves.

The result is a compressed bitmap of kept lines per document that loses any; texts are not returned.

Defined cases: null and empty texts are one empty line; rows that repeat a doc_id count as one document, and each row loses
what the document loses; a null doc_id counts as one document after all others; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.llm import words as W
from ratingmill.session import stage

MIN_CHARS = 10
_LAST_ID = 2**63 - 1
LINES = "h1 bigint, h2 bigint, doc_id bigint, text_id bigint, line int"
_STREAMED = "part int, role int, h1 bigint, h2 bigint, doc_id bigint, text_id bigint, line int"
_DROP, _LEAD, _FIRST, _LAST = range(4)


def text_ids(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return W.span_hashes(W.prefix_sums(data), at[:-1], at[1:])


def line_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and the number of lines of each text; a text of k newlines has k + 1 lines."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((at[:-1], breaks + 1)), kind="stable")
    ends = np.sort(np.concatenate((breaks, at[1:])), kind="stable")
    return starts, ends, np.diff(np.searchsorted(breaks, at)) + 1


def _lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in W.chunks(batch):
                starts, ends, count = line_bounds(data, at)
                solid = np.flatnonzero(~W.white(data))
                held = np.concatenate(([0], np.cumsum(~W.white(data))))
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                low, high = held[starts], held[ends]
                some = np.flatnonzero(high > low)
                begin, end = solid[low[some]], solid[high[some] - 1] + 1
                long = points[end] - points[begin] >= min_chars
                some, begin, end = some[long], begin[long], end[long]
                text = np.repeat(np.arange(len(count)), count)[some]
                line = some - (np.cumsum(count) - count)[text]
                folded = W.fold(data)
                hashes = [W.signed(W.span_hashes(W.prefix_sums(folded, k), begin, end, k)) for k in (0, 1)]
                ids = rows.column("doc_id").take(pa.array(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[0]), pa.array(hashes[1]), ids, pa.array(W.signed(text_ids(data, at))[text]), pa.array(line.astype(np.int32))],
                    ["h1", "h2", "doc_id", "text_id", "line"],
                )

    return run


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that a later document holds again, rows whose fate the task before decides, and the two border rows."""
    part = TaskContext.get().partitionId()
    names = ["h1", "h2", "doc_id", "text_id", "line"]

    def out(role: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        fixed = [pa.array(np.full(len(role), part, np.int32)), pa.array(role.astype(np.int32))]
        return pa.RecordBatch.from_arrays(fixed + [pa.array(c) for c in columns], ["part", "role", *names])

    before, owner, lead = None, None, True
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in names]
        h1, h2, ids = columns[:3]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if before is None:
            yield out(np.array([_FIRST]), [c[:1] for c in columns])
        elif (h1[0], h2[0]) == before:
            new[0] = False
        run = np.cumsum(new) - (1 if new[0] else 0)  # run 0 continues the batch before, or starts here
        firsts = ids[np.flatnonzero(new)] if new[0] else np.concatenate(([owner], ids[np.flatnonzero(new)]))
        later = ids != firsts[run]
        in_lead = (run == 0) & (lead if not new[0] else before is None)
        role = np.where(later, _DROP, _LEAD)
        use = later | in_lead
        yield out(role[use], [c[use] for c in columns])
        lead = bool(in_lead[-1])
        before, owner, last = (h1[-1], h2[-1]), firsts[run[-1]], [c[-1:] for c in columns]
    if last is not None:
        yield out(np.array([_LAST]), last)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_id, line of every line to drop; ``text_id`` tells apart texts that share a doc_id."""
    text = F.coalesce("text", F.lit("")).alias("text")
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("doc_id"), text)
    lines = narrow.mapInArrow(_lines(min_chars), LINES)
    order = ["h1", "h2", "doc_id"]
    streamed = lines.repartitionByRange(*order).sortWithinPartitions(*order, "line").mapInArrow(_streamed, _STREAMED)
    streamed = stage(streamed, "lines")
    # Two rows per task of the sort.
    borders = streamed.filter(F.col("role").isin(_FIRST, _LAST)).orderBy("part", "role").collect()
    ends = {r["part"]: (r["h1"], r["h2"]) for r in borders if r["role"] == _LAST}
    parts = sorted(ends)
    follows = dict(zip(parts[1:], parts))
    continued = [r["part"] for r in borders if r["role"] == _FIRST and ends.get(follows.get(r["part"])) == (r["h1"], r["h2"])]
    # A run longer than a task: every row of it after the first task is dropped, as its documents are larger.
    gone = (F.col("role") == _DROP) | ((F.col("role") == _LEAD) & F.col("part").isin(continued))
    return streamed.filter(gone).select("doc_id", "text_id", "line")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for lines in batch.column("lines"):
            at = np.asarray(lines.values)
            keep = np.ones((at.max() // 8 + 1) * 8, bool)
            keep[at] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_id"), pa.array(packed, pa.binary())], ["doc_id", "text_id", "keep"])


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_id, keep: compressed bits of the lines up to the last dropped one; all later lines stay."""
    lines = dropped_lines(docs, min_chars).groupBy("doc_id", "text_id").agg(F.collect_list("line").alias("lines"))
    return lines.mapInArrow(_bitmaps, "doc_id bigint, text_id bigint, keep binary")


def unpacked(keep: bytes, n: int) -> np.ndarray:
    """The bits of ``n`` lines."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8)).astype(bool)[:n]
    return np.concatenate((bits, np.ones(n - len(bits), bool)))


def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, at in W.chunks(batch):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(W.signed(text_ids(data, at)))], [*rows.schema.names, "text_id"])


def narrowed(docs: DataFrame) -> DataFrame:
    """_id (doc_id, the last one for null), doc_id, text (empty for null)."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("_id")
    return docs.select(key, F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def with_text_id(docs: DataFrame) -> DataFrame:
    """_id, doc_id, text as ``narrowed`` gives them, text_id."""
    return narrowed(docs).mapInArrow(identified, "_id bigint, doc_id bigint, text string, text_id bigint")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, texts = [], [], []
        for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
            lines = text.split("\n")
            n_lines.append(len(lines))
            if keep is not None:
                bits = unpacked(keep, len(lines))
                lines = [line for line, bit in zip(lines, bits) if bit]
            n_dropped.append(n_lines[-1] - len(lines))
            texts.append("\n".join(lines))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "text"],
        )


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines (before), n_dropped, text (the lines that stay): one row per row of ``docs``."""
    keep = keep_bitmaps(docs, min_chars).withColumnRenamed("doc_id", "_id")
    return with_text_id(docs).join(keep, ["_id", "text_id"], "left").mapInArrow(_applied, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")


