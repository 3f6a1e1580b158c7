"""Benchmark decontamination: which documents contain test items.

Containment of an item in a document is the share of the item's distinct five-word shingles that the document has (an
item of fewer words is one shingle of its own length). Documents are far longer than items, so a MinHash of the document
says nothing; the item's does. Items are partitioned by size. The MinHash sketch of an item holds its k smallest shingle
hashes with k = n - ceil(threshold * n) + 1: a document that lacks all k lacks too many shingles, so the sketch
search loses no pair. Each size partition has its own sketch table, its own largest sketch value, above which no shingle
of a document needs a look, and its own least document size. Candidates are verified on the shingles themselves.

Items are read in blocks of bounded size; every block is compared with all documents, and only a block is ever broadcast.

Defined cases: null, empty and wordless texts contain nothing and are contained nowhere; repeated items or documents give
repeated pairs; a null id is kept as null; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.llm import words as W
from ratingmill.session import stage

THRESHOLD = 80  # per cent
BLOCK_SHINGLES = 200_000
SCHEMA = "item_id bigint, doc_id bigint, item_shingles bigint, shared bigint, containment double"
_PAIR = pa.schema(
    [("item_id", pa.int64()), ("doc_id", pa.int64()), ("item_shingles", pa.int64()), ("shared", pa.int64()), ("containment", pa.float64())]
)


def _least(n: int, threshold: int) -> int:
    return -(-n * threshold // 100)


class SizePartition:
    """Sketches of the items whose shingle counts share a power of two and whose shingles have one width."""

    def __init__(self, width: int, items: list[tuple[int, np.ndarray]], threshold: int):
        self.width = width
        self.least = min(_least(len(s), threshold) for _, s in items)
        marks = [s[: len(s) - _least(len(s), threshold) + 1] for _, s in items]
        owner = np.repeat([i for i, _ in items], [len(m) for m in marks])
        marks = np.concatenate(marks)
        order = np.argsort(marks, kind="stable")
        self.marks, self.owner = marks[order], owner[order]
        self.cut = self.marks[-1]

    def candidates(self, shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Distinct (text, item) pairs that share a sketch value."""
        at = np.flatnonzero(shingles <= self.cut)
        low = np.searchsorted(self.marks, shingles[at], "left")
        count = np.searchsorted(self.marks, shingles[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        text = np.searchsorted(begin, at, "right") - 1
        enough = np.diff(begin)[text] >= self.least
        text, low, count = text[enough], low[enough], count[enough]
        k = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.unique(np.stack([np.repeat(text, count), self.owner[k]], 1), axis=0)


class ItemBlock:
    """A block of items with their sketches, sent to the tasks."""

    def __init__(self, ids: list[int | None], texts: list[str], threshold: int):
        self.ids, self.threshold = ids, threshold
        self.sets: list[frozenset[bytes]] = []
        groups: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for i, text in enumerate(texts):
            own = text.encode().lower().split()
            width = min(W.SHINGLE, len(own))
            self.sets.append(frozenset(_shingles(own, width)))
            if width:
                data, at = W.column_bytes(pa.array([text]))
                hashes, _ = W.shingle_sets(data, at, width)
                groups.setdefault((width, len(hashes).bit_length()), []).append((i, hashes))
        self.parts = [SizePartition(width, group, threshold) for (width, _), group in sorted(groups.items())]

    def pairs(self, batch: pa.RecordBatch) -> Iterator[tuple[int | None, int | None, int, int, float]]:
        for rows, data, at in W.chunks(batch):
            hashed, first = W.word_hashes(data, at)
            by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            ids = rows.column("doc_id")
            for part in self.parts:
                if part.width not in by_width:
                    by_width[part.width] = W.shingle_hashes(hashed, first, part.width, short=False)
                last, held = -1, frozenset()
                for text, item in part.candidates(*by_width[part.width]).tolist():
                    if text != last:
                        held = frozenset(_shingles(data[at[text] : at[text + 1]].tobytes().lower().split(), part.width))
                        last = text
                    wanted = self.sets[item]
                    shared = len(wanted & held)
                    if shared * 100 >= len(wanted) * self.threshold:
                        yield self.ids[item], ids[text].as_py(), len(wanted), shared, shared / len(wanted)


def _shingles(own: list[bytes], width: int) -> Iterator[bytes]:
    return (b" ".join(own[i : i + width]) for i in range(len(own) - width + 1)) if width else iter(())


def _item_blocks(benchmark: DataFrame, block_shingles: int) -> Iterator[DataFrame]:
    items = stage(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")), "items")
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // (6 * block_shingles)))
    for k in range(blocks):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """item_id, doc_id, item_shingles, shared, containment: every pair with at least ``threshold`` per cent containment."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for block in _item_blocks(benchmark, block_shingles):
        rows = block.collect()  # one block, bounded by ``block_shingles``
        sent = W.send(spark, ItemBlock([r["item_id"] for r in rows], [r["text"] for r in rows], threshold))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = W.received(sent)
            for batch in batches:
                got = list(items.pairs(batch))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), _PAIR.types)], schema=_PAIR)

        pairs = narrow.mapInArrow(search, SCHEMA)
        found = pairs if found is None else found.unionAll(pairs)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents that contain no item, with all their columns; a row without doc_id stays."""
    hit = contained_items(docs, benchmark, threshold).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)
