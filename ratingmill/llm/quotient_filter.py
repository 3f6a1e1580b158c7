"""Counting quotient filters: sorted, compact and lossless counters of packed keys.

A key of ``bits`` bits is permuted invertibly. The high bits of the permuted key name the shard, the next ones are the quotient,
whose number of entries per slot is stored, and all other bits are stored as the remainder: nothing is hashed away,
so a filter decodes to exactly the keys and counts that were put in. Filters hold their entries in permuted order, so merging filters of one
shard is a merge of sorted runs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_U = np.uint64


@dataclass(frozen=True)
class Permutation:
    """A bijection of the integers below 2^bits: folding shifts, which undo themselves, and odd factors."""

    bits: int

    def _fold(self, x: np.ndarray) -> np.ndarray:
        return x ^ (x >> _U((self.bits + 1) // 2))

    @property
    def _mask(self) -> np.uint64:
        return _U((1 << self.bits) - 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        for factor in _MULTIPLIERS:
            x = (self._fold(x) * _U(factor)) & self._mask
        return self._fold(x)

    def inverse(self, y: np.ndarray) -> np.ndarray:
        y = self._fold(y)
        for factor in reversed(_MULTIPLIERS):
            y = self._fold((y * _U(pow(factor, -1, 1 << 64))) & self._mask)
        return y


def counted(sorted_keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted array and how often, or with which sum of ``counts``, each stands in it."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    at = np.flatnonzero(new)
    if counts is None:
        return sorted_keys[at], np.diff(np.append(at, len(sorted_keys)))
    return sorted_keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _pressed(data: bytes) -> bytes:
    """Entropy-coded, after its two lengths: the bytes of a plane are alike, so each plane is coded alone."""
    coded = pa.Codec("zstd", compression_level=1).compress(data, asbytes=True) if data else b""
    return len(data).to_bytes(4, "little") + len(coded).to_bytes(4, "little") + coded


def _restored(data: bytes, at: int) -> tuple[np.ndarray, int]:
    """The plane at a place and where the next one begins."""
    size, length = (int.from_bytes(data[at + k : at + k + 4], "little") for k in (0, 4))
    end = at + 8 + length
    return np.frombuffer(pa.Codec("zstd").decompress(data[at + 8 : end], size, asbytes=True) if size else b"", np.uint8), end


def pack(values: np.ndarray) -> bytes:
    """Integers of any size as planes: all lowest bytes, all next ones, and so on up to the highest that is used."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize)
    used = max((k + 1 for k in range(values.itemsize) if planes[:, k].any()), default=0)
    return bytes([used]) + len(values).to_bytes(8, "little") + b"".join(_pressed(planes[:, k].tobytes()) for k in range(used))


def unpack(data: bytes, kind) -> np.ndarray:
    values = np.zeros(int.from_bytes(data[1:9], "little"), kind)
    planes, at = values.view(np.uint8).reshape(len(values), values.itemsize), 9
    for k in range(data[0]):
        planes[:, k], at = _restored(data, at)
    return values


def _small(values: np.ndarray) -> bytes:
    """One byte per value; those from 255 on follow in full."""
    return _pressed(np.minimum(values, 255).astype(np.uint8).tobytes()) + _pressed(values[values >= 255].astype(np.int64).tobytes())


def _read_small(data: bytes, at: int) -> tuple[np.ndarray, int]:
    values, at = _restored(data, at)
    large, at = _restored(data, at)
    values = values.astype(np.int64)
    values[values == 255] = large.view(np.int64)
    return values, at


def encode(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of sorted distinct permuted keys below 2^bits with their counts."""
    n = len(keys)
    slots = min(bits, max(0, n.bit_length() - 1))
    rest = bits - slots
    width = -(-rest // 8)
    quotients = (keys >> _U(rest)).astype(np.int64) if rest < 64 else np.zeros(n, np.int64)
    remainders = keys & _U((1 << rest) - 1)
    held = np.bincount(quotients, minlength=1 << slots)
    low = np.ascontiguousarray(remainders.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return bytes([slots]) + n.to_bytes(8, "little") + _small(held) + b"".join(_pressed(low[:, k].tobytes()) for k in range(width)) + _small(counts)


def decode(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    slots, n = data[0], int.from_bytes(data[1:9], "little")
    rest = bits - slots
    width = -(-rest // 8)
    held, at = _read_small(data, 9)
    low = np.zeros((n, 8), np.uint8)
    for k in range(width):
        low[:, k], at = _restored(data, at)
    counts, _ = _read_small(data, at)
    quotients = np.repeat(np.arange(1 << slots, dtype=np.uint64), held)
    high = quotients << _U(rest) if rest < 64 else np.zeros(n, np.uint64)
    return high | low.reshape(-1).view("<u8").astype(np.uint64), counts


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts of equal keys. The stable sort of concatenated sorted runs merges them."""
    keys = np.concatenate([k for k, _ in filters])
    counts = np.concatenate([c for _, c in filters])
    order = np.argsort(keys, kind="stable")
    return counted(keys[order], counts[order])
