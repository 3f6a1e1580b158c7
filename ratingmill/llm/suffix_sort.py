"""Deep-shallow sorting of suffixes in one task: multikey quicksort, then blind tries.

Suffixes are compared on their first ``limit`` bytes. The shallow phase refines groups of equal prefixes by the next word
of eight bytes, all groups at once; what still shares ``SHALLOW`` bytes goes to a blind trie, which stores only the depth
and the byte of each branch, so a suffix of a long common prefix is compared with one other suffix.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as a number that sorts as they do; ``data`` has eight spare bytes."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[at + k]
    return out


def multikey(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by ``depth`` bytes (a multiple of eight), and their group numbers in that order."""
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    for d in range(0, depth, 8):
        if not len(open_):
            break
        key = _words(data, starts[order[open_]] + d)
        by = np.lexsort((key, group[open_]))
        key, own = key[by], group[open_][by]
        order[open_] = order[open_][by]
        new = np.ones(len(by), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        # A group is numbered by the place of its first suffix, so numbers stay unique and in order.
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
    return order, group


class BlindTrie:
    """Suffixes with a long common prefix, told apart by branch bytes only."""

    def __init__(self, data: bytes, limit: int, depth: int):
        self._data, self._limit, self._root, self._depth = data, limit, None, depth

    def _common(self, a: int, b: int) -> int:
        data, low, high = self._data, self._depth, self._limit
        if data[a : a + high] == data[b : b + high]:
            return high
        while high - low > 1:
            middle = (low + high) // 2
            if data[a + low : a + middle] == data[b + low : b + middle]:
                low = middle
            else:
                high = middle
        return low

    def insert(self, start: int, name: int) -> None:
        if self._root is None:
            self._root = [name], start
            return
        node = self._root
        while isinstance(node, dict):  # any leaf below is as good as the right one
            node = node.get(self._data[start + node[-1]]) or node[node[-2]]
        common = self._common(start, node[1])
        if common == self._limit:
            node[0].append(name)
            return
        above, byte, node = None, None, self._root
        while isinstance(node, dict) and node[-1] < common:
            above, byte = node, self._data[start + node[-1]]
            node = node[byte]
        leaf = [name], start
        if isinstance(node, dict) and node[-1] == common:
            node[self._data[start + common]] = leaf
            return
        some = node
        while isinstance(some, dict):
            some = some[some[-2]]
        old = self._data[some[1] + common]
        fork = {-1: common, -2: old, old: node, self._data[start + common]: leaf}
        if above is None:
            self._root = fork
        else:
            above[byte] = fork

    def leaves(self):
        """Names of equal suffixes, leaf by leaf in order."""
        stack = [self._root]
        while stack:
            node = stack.pop()
            if isinstance(node, dict):
                stack.extend(node[b] for b in sorted((b for b in node if b >= 0), reverse=True))
            elif node is not None:
                yield node[0]


def suffix_order(data: np.ndarray, starts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``limit`` bytes, and whether each, in that order, equals the one before it.

    Every start has ``limit`` bytes behind it.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    shallow = min(SHALLOW, limit // 8 * 8)
    order, group = multikey(padded, starts, shallow)
    same = np.zeros(len(starts), bool)
    edges = np.flatnonzero(np.diff(group)) + 1
    raw = data.tobytes()
    for low, high in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(starts)]))):
        if high - low < 2:
            continue
        trie = BlindTrie(raw, limit, shallow)
        for name in order[low:high].tolist():
            trie.insert(int(starts[name]), name)
        at = low
        for names in trie.leaves():
            order[at : at + len(names)] = names
            same[at + 1 : at + len(names)] = True
            at += len(names)
    return order, same
