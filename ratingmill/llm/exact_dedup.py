"""Exact deduplication with a cuckoo-filter index of live digests.

Texts are equal when they are identical after each run of space and 0x09-0x0D becomes one space (null counts as
empty). The index has one cuckoo filter per shard: 16-bit fingerprints, four slots per bucket. Next to each
fingerprint stands the full digest, so a filter hit is verified against the content of the bucket, and a full filter is
rebuilt with twice the buckets from the digests it stores. Digests can be inserted and deleted at any time.

Defined cases: an empty table gives an empty result; null and empty texts are one group; rows that repeat a doc_id and
text share their decision; a null doc_id loses to any other; extra columns are ignored by ``digests``.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.session import stage

SHARD_ROWS = 200_000  # digests a shard is planned for; a filter may grow beyond it
_SLOTS = 4
_KICKS = 200
INDEX_SCHEMA = "shard int, digest binary, keep_id bigint, group_size bigint"


class CuckooIndex:
    """A cuckoo filter whose slots point to the stored digests."""

    def __init__(self, capacity: int = 1024):
        self._keys: list[bytes] = []
        self.kept: list[int | None] = []
        self.sizes: list[int] = []
        self._allocate(max(capacity, 8))

    def __len__(self) -> int:
        return len(self._keys)

    def _allocate(self, capacity: int) -> None:
        n = 2
        while n * _SLOTS * 0.85 < capacity:
            n *= 2
        self._buckets = n
        self._prints = array("H", bytes(2 * n * _SLOTS))
        self._entries = array("q", bytes(8 * n * _SLOTS))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        one = int.from_bytes(digest[2:10], "little") & (self._buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & (self._buckets - 1))

    def find(self, digest: bytes) -> int:
        """Entry of a stored digest, or -1. A fingerprint alone never decides."""
        mark, one, two = self._places(digest)
        for bucket in (one, two):
            for slot in range(bucket * _SLOTS, bucket * _SLOTS + _SLOTS):
                if self._prints[slot] == mark and self._keys[self._entries[slot]] == digest:
                    return self._entries[slot]
        return -1

    def insert(self, digest: bytes, keep_id: int | None, size: int = 1) -> bool:
        """Add a digest or merge into the stored one; True if it is new."""
        entry = self.find(digest)
        if entry >= 0:
            known = self.kept[entry]
            self.kept[entry] = keep_id if known is None else known if keep_id is None else min(known, keep_id)
            self.sizes[entry] += size
            return False
        self._keys.append(digest)
        self.kept.append(keep_id)
        self.sizes.append(size)
        if not self._place(len(self._keys) - 1):
            self._grow()
        return True

    def _place(self, entry: int) -> bool:
        mark, one, two = self._places(self._keys[entry])
        bucket = one
        for kick in range(_KICKS):
            for choice in (one, two) if kick == 0 else (bucket,):
                for slot in range(choice * _SLOTS, choice * _SLOTS + _SLOTS):
                    if not self._prints[slot]:
                        self._prints[slot], self._entries[slot] = mark, entry
                        return True
            slot = bucket * _SLOTS + (kick + entry) % _SLOTS
            mark, self._prints[slot] = self._prints[slot], mark
            entry, self._entries[slot] = self._entries[slot], entry
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        capacity = int(self._buckets * _SLOTS)
        while True:
            self._allocate(capacity)
            if all(self._place(entry) for entry in range(len(self._keys))):
                return
            capacity *= 2

    def delete(self, digest: bytes) -> bool:
        """Forget a live digest; its entry is filled by the last one."""
        entry = self.find(digest)
        if entry < 0:
            return False
        self._prints[self._slot_of(entry)] = 0
        last = len(self._keys) - 1
        if entry != last:
            self._entries[self._slot_of(last)] = entry
            for column in (self._keys, self.kept, self.sizes):
                column[entry] = column[last]
        for column in (self._keys, self.kept, self.sizes):
            column.pop()
        return True

    def _slot_of(self, entry: int) -> int:
        mark, one, two = self._places(self._keys[entry])
        for bucket in (one, two):
            for slot in range(bucket * _SLOTS, bucket * _SLOTS + _SLOTS):
                if self._prints[slot] == mark and self._entries[slot] == entry:
                    return slot
        raise KeyError(entry)

    def table(self, shard: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(self), pa.int32()),
                pa.array(self._keys, pa.binary()),
                pa.array(self.kept, pa.int64()),
                pa.array(self.sizes, pa.int64()),
            ],
            ["shard", "digest", "keep_id", "group_size"],
        )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the normalised text, as hex and as bytes."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of a batch, so that a hot digest reaches its shard once per batch."""
    for batch in batches:
        rows = pa.table({"digest": batch.column("digest"), "keep_id": batch.column("doc_id")})
        got = rows.group_by("digest").aggregate([("keep_id", "min"), ("keep_id", "count", pa.compute.CountOptions(mode="all"))])
        got = pa.table({"digest": got["digest"], "keep_id": got["keep_id_min"], "group_size": got["keep_id_count"]})
        yield from got.to_batches()


def _through_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one shard's digests through its filter; only distinct digests are held."""
    shard, index = 0, CuckooIndex()
    for batch in batches:
        for s, digest, keep_id, size in zip(*(batch.column(c).to_pylist() for c in ("shard", "digest", "keep_id", "group_size"))):
            shard = s
            index.insert(digest, keep_id, size)
    if len(index):
        yield index.table(shard)


def _shard(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int").alias("shard")


def build_index(digests: DataFrame, shards: int) -> DataFrame:
    """The index of a table (doc_id, digest): one row per live digest with the smallest doc_id and the number of rows."""
    rows = digests.mapInArrow(_collapsed, "digest binary, keep_id bigint, group_size bigint")
    rows = rows.select(_shard(shards), "*")
    return rows.groupBy("shard").applyInArrow(_through_filter, INDEX_SCHEMA)


def apply_changes(index: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """The index after changes (op 'insert' or 'delete', doc_id, digest); deletions of a batch come first.

    Deleting a digest forgets all its copies; deleting an unknown digest changes nothing.
    """

    def shard_changes(stored: pa.Table, changed: pa.Table) -> pa.Table:
        live = CuckooIndex(stored.num_rows)
        for digest, keep_id, size in zip(*(stored[c].to_pylist() for c in ("digest", "keep_id", "group_size"))):
            live.insert(digest, keep_id, size)
        rows = list(zip(*(changed[c].to_pylist() for c in ("op", "digest", "doc_id"))))
        for op, digest, _ in rows:
            if op == "delete":
                live.delete(digest)
        for op, digest, doc_id in rows:
            if op == "insert":
                live.insert(digest, doc_id)
        shard = (stored["shard"] if stored.num_rows else changed["shard"])[0].as_py()
        return pa.Table.from_batches([live.table(shard)])

    changed = changes.filter(F.col("digest").isNotNull()).select(_shard(shards), "op", "digest", "doc_id")
    return index.groupBy("shard").cogroup(changed.groupBy("shard")).applyInArrow(shard_changes, INDEX_SCHEMA)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``; the smallest doc_id of a group stays."""
    hashed = stage(digests(docs), "digests")
    shards = max(1, -(-hashed.count() // SHARD_ROWS))
    index = build_index(hashed.select("doc_id", F.unhex("text_sha256").alias("digest")), shards)
    found = index.select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "group_size")
    return hashed.join(found, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
