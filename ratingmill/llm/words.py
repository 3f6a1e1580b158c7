"""Words, shingles and their hashes of whole Arrow string columns, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D; A-Z fold to lower case, other letters stay.
Null text counts as empty.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

SHINGLE = 5
CHUNK_BYTES = 1 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# Two independent byte tables and odd multipliers: one 64-bit hash each.
_BYTE = [np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) for seed in (11, 12)]
_BASE = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def send(spark, value):
    """A broadcast that carries the code of ``value`` too: plain broadcasts look its class up on the executors."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent):
    return pickle.loads(sent.value)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, CHUNK_BYTES)
        base = _BASE[which]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[which] = (both[0], both[1])
    return _POWERS[which]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets, starting at 0."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``limit`` text bytes (a longer text is a slice of its own), its bytes and offsets."""
    data, at = column_bytes(batch.column(text))
    low, n = 0, batch.num_rows
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield batch.slice(low, high - low), data[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def fold(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]


def white(data: np.ndarray) -> np.ndarray:
    return _WHITE[data]


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n+1 entries)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    solid = ~_WHITE[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:n]
    last = solid
    last[:-1] &= ~solid[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def prefix_sums(folded: np.ndarray, which: int = 0) -> np.ndarray:
    sums = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(_BYTE[which][folded] * _powers(which, len(folded) + 1)[0][: len(folded)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans from the prefix sums of the folded bytes."""
    return mixed((sums[ends] - sums[starts]) * _powers(which, len(sums))[1][starts])


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all folded words, and for each text the index of its first word."""
    starts, ends, first = word_bounds(data, at)
    return span_hashes(prefix_sums(fold(data)), starts, ends), first


_ROLL = 0xA24BAED4963EE407


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = SHINGLE, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each text and the index of each text's first.

    With ``short`` a text of fewer words has its whole sequence as the only shingle; without words there is none.
    """
    n = np.diff(first)
    count = np.maximum(n - width + 1, 0)
    if short:
        count = np.where((n > 0) & (n < width), 1, count)
    begin = np.concatenate(([0], np.cumsum(count)))
    start = np.repeat(first[:-1], count) + np.arange(begin[-1]) - np.repeat(begin[:-1], count)
    length = np.repeat(np.minimum(n, width), count)
    total = np.zeros(len(start), np.uint64)
    for k in range(width):
        use = length > k
        if use.all():
            total = mixed(total * np.uint64(_ROLL) + words[start + k])
        else:
            total[use] = mixed(total[use] * np.uint64(_ROLL) + words[start[use] + k])
    return total, begin


def distinct_per_text(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text and the index of each text's first."""
    text = np.repeat(np.arange(len(begin) - 1, dtype=np.int64), np.diff(begin))
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(len(begin)))


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The set of shingle hashes of each text, sorted, and where each begins."""
    words, first = word_hashes(data, at)
    return distinct_per_text(*shingle_hashes(words, first, width))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class Lookup:
    """Rows of a table by 64-bit key."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        self.rows = np.concatenate([rows[order], np.zeros((1, *rows.shape[1:]), rows.dtype)])
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        slots = np.arange(2 ** (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.start = np.searchsorted(self.keys, slots).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key; that of a row of zeros where it is unknown."""
        at = self.start[keys >> self.shift].astype(np.int64)
        behind = np.flatnonzero(self.keys[at] < keys)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < keys[behind]]
        at[self.keys[at] != keys] = len(self.keys) - 1
        return at
