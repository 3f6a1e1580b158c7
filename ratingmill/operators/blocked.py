"""Exact top-k of a product of two sparse row tables, computed block by block.

Both inputs are long tables ``(id, feature, weight)``. A self-join on ``feature`` would emit every
pair of ids that share a feature: quadratic in the most frequent feature. Here left ids are hashed
into blocks of bounded size. A task holds one left block and reads right rows, one packed row per
id, in the order of their ids; only the best ``k`` columns of every left row leave the task. A
frequent feature is thereby spread over all tasks. A right row travels once per left block, so left
blocks are multiplied in rounds: what one round ships is bounded by the size of the input, and its
shuffle files are gone before the next. Ids with very long rows are scored by a join with partial
aggregation instead, and their scores handed to the tasks, so no task holds an unbounded row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingmill.operators.ranking import top_per_group
from ratingmill.session import stage, stage_alone

# Send the task function with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a shipped row means inside a task, in the order in which a task reads them.
_LEFT, _SKIP, _FIXED, _RIGHT = 0, 1, 2, 3
_SHIPPED = ["part", "kind", "id", "key", "weight"]
_MATCHES = 1_000_000  # matched entries a task works on at once
CELLS = 4_000_000  # cells of the dense score slice a task works on
_CHUNK = 2_048  # columns of one matrix product, fewer if there are many features


Product = Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Score:
    """How the shared features of a pair become its score.

    ``dense`` gets a function that sums left times right weights over shared features, the
    feature of every left entry and both weight arrays. ``column`` is the same score as an
    aggregate over joined rows (feature, lw, rw).
    """

    dense: Callable[[Product, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    column: Callable[[Column, Column, Column], Column]


DOT = Score(
    dense=lambda product, feature, lw, rw: product(lw, rw),
    column=lambda feature, lw, rw: F.sum(lw * rw),
)


def _divide(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    return np.divide(top, bottom, out=np.zeros_like(top), where=bottom != 0)


# Weighted mean: the denominator counts the right weights of non-zero left weights.
WEIGHTED_MEAN = Score(
    dense=lambda product, feature, lw, rw: _divide(product(lw, rw), product((lw != 0).astype(float), np.abs(rw))),
    column=lambda feature, lw, rw: F.coalesce(
        F.try_divide(F.sum(lw * rw), F.sum(F.when(lw != 0, F.abs(rw)))), F.lit(0.0)
    ),
)


@dataclass(frozen=True)
class BlockPlan:
    """Size limits of a block. Left ids are scored in slices, so a left block may hold more."""

    left_ids: int = 16_384
    right_ids: int = 32_768
    entries: int = 2_000_000
    long_row: int = 500_000  # entries of one id above which it is scored by a join
    held_ids: int = 131_072  # left ids a task holds with their best k while right rows pass
    shipped: int = 16_000_000  # entries a round may ship however small the input is


@dataclass(frozen=True)
class _Side:
    ids: int
    entries: int
    has_long: bool

    def blocks(self, ids_limit: int, plan: BlockPlan) -> int:
        return max(1, ceil(self.ids / ids_limit), ceil(self.entries / plan.entries))


def measure(rows: DataFrame, plan: BlockPlan) -> _Side:
    sizes = rows.groupBy("id").agg(F.count("*").alias("n"))
    short = F.col("n") <= plan.long_row
    ids, entries, longest = sizes.agg(
        F.count("*"), F.coalesce(F.sum(F.when(short, F.col("n"))), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))
    ).first()
    return _Side(ids, entries, longest > plan.long_row)


def _rounds(left: _Side, right: _Side, plan: BlockPlan, slots: int) -> tuple[int, int, int]:
    """Left blocks, left blocks in a round and right slices: within the limits, and enough tasks to keep every slot busy.

    A right entry travels to each left block of a round, a left entry to each right slice. A round ships at most twice both
    inputs, or one left block against the right side.
    """
    least = left.blocks(plan.held_ids, plan)

    def slices(blocks: int) -> int:
        return max(1, min(ceil(slots / blocks), ceil(right.ids / 256)))

    most = max(least, min(slots, ceil(left.ids / 256)))
    blocks = min(range(least, most + 1), key=lambda n: (n * slices(n) < slots, n * right.entries + slices(n) * left.entries))
    allowed = max(plan.shipped, 2 * (left.entries + right.entries))
    at_once = blocks
    if blocks * right.entries + slices(blocks) * left.entries > allowed:
        at_once = max(1, min(blocks, allowed // max(right.entries, 1)))
    return blocks, at_once, slices(at_once)


def block_of(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _packed(rows: DataFrame, *groups: Column, most: int) -> DataFrame:
    """One row (id, groups, key, weight) with two flat arrays per id and group, cut where it would hold more than ``most`` entries."""
    longest = rows.groupBy("id").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    piece = F.pmod(F.xxhash64("key"), F.lit(max(1, ceil(longest / most)))).alias("_piece")
    # A null feature is shared with nothing, but its id stays known.
    entry = F.when(F.col("key").isNotNull(), F.struct("key", "weight"))
    lists = rows.groupBy("id", *groups, piece).agg(F.collect_list(entry).alias("_entries"))
    return lists.withColumns({"key": F.col("_entries.key"), "weight": F.col("_entries.weight")}).drop("_piece", "_entries")


def _long_scores(left: DataFrame, right: DataFrame, long_left: DataFrame, long_right: DataFrame, score: Score) -> DataFrame:
    """Scores of all pairs in which one side has a long row: (id, key, weight)."""

    def joined(lefts: DataFrame, rights: DataFrame) -> DataFrame:
        lhs = lefts.select("feature", F.col("id").alias("_l"), F.col("weight").alias("lw"))
        rhs = rights.select("feature", F.col("id").alias("_r"), F.col("weight").alias("rw"))
        return (
            lhs.join(rhs, "feature")
            .groupBy("_l", "_r")
            .agg(score.column(F.col("feature"), F.col("lw"), F.col("rw")).alias("weight"))
            .select(F.col("_l").alias("id"), F.col("_r").alias("key"), "weight")
        )

    left_long = left.join(long_left, "id", "left_semi")
    left_short = left.join(long_left, "id", "left_anti")
    return joined(left_long, right).unionByName(joined(left_short, right.join(long_right, "id", "left_semi")))


def sparse_product(lrow, lfeat, rptr, rcol, start: int, stop: int, n_cols: int) -> Product:
    """Products of rows start..stop: every left entry meets the right entries of its feature."""
    first, last = np.searchsorted(lrow, [start, stop])
    counts = rptr[lfeat[first:last] + 1] - rptr[lfeat[first:last]]
    left_at = np.repeat(np.arange(first, last), counts)
    skipped = np.repeat(np.cumsum(counts) - counts, counts)
    right_at = np.arange(counts.sum()) - skipped + rptr[lfeat[left_at]]
    cell = (lrow[left_at] - start) * n_cols + rcol[right_at]
    size = (stop - start) * n_cols

    def product(lw: np.ndarray, rw: np.ndarray) -> np.ndarray:
        return np.bincount(cell, lw[left_at] * rw[right_at], size).reshape(stop - start, n_cols)

    return product


def dense_product(lrow, lfeat, rfeat, rcol, start: int, stop: int, n_cols: int, n_feat: int) -> Product:
    """The same for well-filled rows, as matrix products over chunks of columns."""
    first, last = np.searchsorted(lrow, [start, stop])
    by_col = np.argsort(rcol, kind="stable")
    chunk = min(_CHUNK, max(64, CELLS // max(n_feat, 1)))
    edges = np.arange(0, n_cols + chunk, chunk)
    cuts = np.searchsorted(rcol[by_col], edges)

    def product(lw: np.ndarray, rw: np.ndarray) -> np.ndarray:
        lhs, out = np.zeros((stop - start, n_feat)), np.empty((stop - start, n_cols))
        lhs[lrow[first:last] - start, lfeat[first:last]] = lw[first:last]
        for edge, low, high in zip(edges, cuts, cuts[1:]):
            at, width = by_col[low:high], min(chunk, n_cols - edge)
            rhs = np.zeros((n_feat, width))
            rhs[rfeat[at], rcol[at] - edge] = rw[at]
            out[:, edge : edge + width] = lhs @ rhs
        return out

    return product


def best_columns(scores: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best finite scores per row, ties to the lower column.

    Without k: of all scores that are not zero.
    """
    if k is None:
        return np.nonzero((scores != 0) & np.isfinite(scores))
    if scores.shape[1] > k:
        edge = np.partition(scores, -k, axis=1)[:, [-k]]
        rows, cols = np.nonzero((scores >= edge) & np.isfinite(scores))
    else:
        rows, cols = np.nonzero(np.isfinite(scores))
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k]


def _lists(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, number of entries of each row, and key and weight of every entry, by row."""
    if not batches:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    table = pa.Table.from_batches(batches).combine_chunks()
    keys, weights = (pa.concat_arrays(table[c].chunks) for c in ("key", "weight"))
    lengths = np.diff(keys.offsets.to_numpy())
    return table["id"].to_numpy(), lengths, keys.flatten().to_numpy(), weights.flatten().to_numpy(zero_copy_only=False)


class _LeftBlock:
    """A left block by feature, the pairs of its ids that are skipped or given, and the best ``k`` scores so far."""

    def __init__(self, parts: dict[int, list[pa.RecordBatch]], k: int | None):
        ids, lengths, feature, weight = _lists(parts[_LEFT])
        self.ids, place = np.unique(ids, return_inverse=True)
        self.k, n = k, len(self.ids)
        row = np.repeat(place, lengths)
        order = np.lexsort((row, feature))
        self.row, self.feature, self.weight = row[order], feature[order], weight[order]
        self.features, first = np.unique(self.feature, return_index=True)
        self.ptr = np.append(first, len(self.feature))
        self._skip, self._fixed = self._pairs(parts[_SKIP]), self._pairs(parts[_FIXED])
        self._pool: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._held, self._kept = 0, 0
        self.least = np.full(n, -np.inf)
        self.counted, self.positive, self.zeros = (np.zeros(n, np.int64) for _ in range(3))

    def _pairs(self, batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, key and weight of pairs, by key."""
        ids, lengths, key, weight = _lists(batches)
        owner = np.repeat(ids, lengths)
        known = np.isin(owner, self.ids)
        row, key, weight = np.searchsorted(self.ids, owner[known]), key[known], weight[known]
        order = np.argsort(key, kind="stable")
        return row[order], key[order], weight[order]

    def _of(self, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], rids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and weight of the pairs whose key is one of ``rids``, which ascend."""
        low, high = np.searchsorted(pairs[1], [rids[0], rids[-1] + 1])
        row, key, weight = (c[low:high] for c in pairs)
        col = np.searchsorted(rids, key)
        use = rids[col] == key
        return row[use], col[use], weight[use]

    def skipped(self, rids: np.ndarray, skip_self: bool) -> tuple[np.ndarray, np.ndarray]:
        row, col, _ = self._of(self._skip, rids)
        if skip_self:
            _, at_l, at_r = np.intersect1d(self.ids, rids, return_indices=True)
            row, col = np.append(row, at_l), np.append(col, at_r)
        return row, col

    def given(self, rids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._of(self._fixed, rids)

    def add(self, row: np.ndarray, right: np.ndarray, score: np.ndarray) -> None:
        if self.k is not None:
            use = score >= self.least[row]
            row, right, score = row[use], right[use], score[use]
        self._pool.append((row, right, score))
        self._held += len(row)
        if self.k is not None and self._held > max(_MATCHES, 2 * self._kept):
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best k per row, ties to the lower right id; without k everything added since the last call."""
        if not self._pool:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, right, score = (np.concatenate(c) for c in zip(*self._pool))
        if self.k is None:
            self._pool, self._held = [], 0
            return row, right, score
        order = np.lexsort((right, -score, row))
        row, right, score = row[order], right[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        row, right, score = row[best], right[best], score[best]
        last = place[best] == self.k - 1
        self.least[row[last]] = score[last]
        self._pool, self._held, self._kept = [(row, right, score)], len(row), len(row)
        return row, right, score


def _whole_scores(block: _LeftBlock, rids, rcol, rkey, rw, full: bool, digits: int, score: Score, skip_self: bool, nonzero: bool) -> None:
    """Scores of all cells of the held rows and the columns ``rids``, slice by slice; the best of each slice are added."""
    features = np.unique(rkey)
    use = np.isin(block.feature, features)
    lrow, lkey, lw = block.row[use], block.feature[use], block.weight[use]
    by_row = np.argsort(lrow, kind="stable")
    lrow, lkey, lw = lrow[by_row], lkey[by_row], lw[by_row]
    lfeat, rfeat = np.searchsorted(features, lkey), np.searchsorted(features, rkey)
    by_feature = np.argsort(rfeat, kind="stable")
    rcol, rfeat, rw = rcol[by_feature], rfeat[by_feature], rw[by_feature]
    rptr = np.searchsorted(rfeat, np.arange(len(features) + 1))
    fixed_row, fixed_col, fixed = block.given(rids)
    skip_row, skip_col = block.skipped(rids, skip_self)
    # Slice so that both the dense scores and the matched entries stay small.
    work = np.zeros(len(block.ids), dtype=np.int64)
    if not full:
        np.add.at(work, lrow, rptr[lfeat + 1] - rptr[lfeat])
    # In the dense path a row also holds one cell per feature.
    cost = np.cumsum(np.maximum(work, len(rids) + (len(features) if full else 0)))
    start = 0
    while start < len(block.ids):
        done = cost[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(cost, done + CELLS, side="right")))
        if full:
            product = dense_product(lrow, lfeat, rfeat, rcol, start, stop, len(rids), len(features))
        else:
            product = sparse_product(lrow, lfeat, rptr, rcol, start, stop, len(rids))
        scores = score.dense(product, lkey, lw, rw)
        at = (fixed_row >= start) & (fixed_row < stop)
        scores[fixed_row[at] - start, fixed_col[at]] = fixed[at]
        scores = np.round(scores, digits) + 0.0
        at = (skip_row >= start) & (skip_row < stop)
        scores[skip_row[at] - start, skip_col[at]] = -np.inf
        if nonzero:
            scores[scores == 0] = -np.inf
            block.counted[start:stop] += np.isfinite(scores).sum(1)
        rows, cols = best_columns(scores, block.k)
        block.add(rows + start, rids[cols], scores[rows, cols])
        start = stop


def _matched_scores(block: _LeftBlock, rids, rcol, rkey, rw, digits: int, score: Score, skip_self: bool, nonzero: bool) -> None:
    """Scores of the cells with a shared feature only; of the others, which score 0, the lowest right ids are added while they may count."""
    at = np.searchsorted(block.features, rkey)
    n = block.ptr[at + 1] - block.ptr[at]
    # Entries are in the order of the columns: whole columns, as many as stay small.
    edges = np.searchsorted(rcol, np.arange(len(rids) + 1))
    ends = np.append(0, np.cumsum(n))[edges]
    start = 0
    while start < len(rids):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + _MATCHES, side="right")) - 1)
        use = slice(edges[start], edges[stop])
        _matched_slice(block, rids[start:stop], rcol[use] - start, at[use], n[use], rw[use], digits, score, skip_self, nonzero)
        start = stop


def _matched_slice(block: _LeftBlock, rids, rcol, at, n, rw, digits: int, score: Score, skip_self: bool, nonzero: bool) -> None:
    """The same for columns with few matched entries: right entry i meets the n[i] left entries of feature at[i]."""
    rows = len(block.ids)
    left_at = np.arange(n.sum()) + np.repeat(block.ptr[at] - np.cumsum(n) + n, n)
    right_at = np.repeat(np.arange(len(at)), n)
    cells, size = rcol[right_at] * rows + block.row[left_at], len(rids) * rows
    if size <= 4 * len(cells):
        place, cells = cells, None
    else:
        cells, place = np.unique(cells, return_inverse=True)
        size = len(cells)

    def product(lw: np.ndarray, rw: np.ndarray) -> np.ndarray:
        return np.bincount(place, lw[left_at] * rw[right_at], size)

    scores = np.round(score.dense(product, block.feature, block.weight, rw), digits) + 0.0
    fixed_row, fixed_col, fixed = block.given(rids)
    cells = np.append(np.arange(size) if cells is None else cells, fixed_col * rows + fixed_row)
    scores = np.append(scores, np.round(fixed, digits) + 0.0)
    use = (scores != 0) & np.isfinite(scores)
    cells, scores = cells[use], scores[use]
    skip_row, skip_col = block.skipped(rids, skip_self)
    skipped = np.unique(skip_col * rows + skip_row)
    if len(skipped):
        place = np.minimum(np.searchsorted(skipped, cells), len(skipped) - 1)
        use = skipped[place] != cells
        cells, scores = cells[use], scores[use]
    row, col = cells % rows, cells // rows
    block.add(row, rids[col], scores)
    if nonzero:
        block.counted += np.bincount(row, minlength=rows)
    elif block.k is not None:
        block.positive += np.bincount(row[scores > 0], minlength=rows)
        _add_zeros(block, rids, np.append(row, skipped % rows), np.append(col, skipped // rows))


def _add_zeros(block: _LeftBlock, rids: np.ndarray, row: np.ndarray, col: np.ndarray) -> None:
    """Per row the lowest right ids that are not among the cells (row, col), as long as fewer than k scores are known to be above 0."""
    start = 0
    while start < len(rids):
        short = np.flatnonzero((block.zeros < block.k) & (block.positive < block.k))
        if not len(short):
            return
        stop = min(len(rids), start + max(4 * block.k, CELLS // len(short)))
        free = np.ones((len(short), stop - start), dtype=bool)
        place = np.full(len(block.ids), -1)
        place[short] = np.arange(len(short))
        use = (col >= start) & (col < stop) & (place[row] >= 0)
        free[place[row[use]], col[use] - start] = False
        at, cols = np.nonzero(free)
        number = np.arange(len(at)) - np.searchsorted(at, at) + block.zeros[short[at]]
        at, cols = at[number < block.k], cols[number < block.k]
        block.add(short[at], rids[cols + start], np.zeros(len(at)))
        block.zeros += np.bincount(short[at], minlength=len(block.ids))
        start = stop


def _block_kernel(k: int | None, digits: int, score: Score, skip_self: bool, plan: BlockPlan, nonzero: bool = False):
    none = np.zeros(0)
    # A score that is not 0 without a shared feature needs every cell.
    empty = np.round(score.dense(lambda lw, rw: np.zeros((1, 1)), np.zeros(0, np.int64), none, none), digits)
    every = bool(np.any(empty != 0))

    def multiply(block: _LeftBlock, rights: list[pa.RecordBatch]) -> None:
        rids, lengths, rkey, rw = _lists(rights)
        rcol = np.repeat(np.arange(len(rids)), lengths)
        at = np.searchsorted(block.features, rkey)
        known = at < len(block.features)
        known[known] = block.features[at[known]] == rkey[known]
        rcol, rkey, rw, at = rcol[known], rkey[known], rw[known], at[known]
        features = len(np.unique(at))
        work = int((block.ptr[at + 1] - block.ptr[at]).sum())
        # A matched entry costs some hundred times a cell of a matrix product.
        full = features <= 16_384 and work > 0.005 * len(block.ids) * len(rids) * features
        if every or full:
            _whole_scores(block, rids, rcol, rkey, rw, full, digits, score, skip_self, nonzero)
        else:
            _matched_scores(block, rids, rcol, rkey, rw, digits, score, skip_self, nonzero)

    def taken(parts: dict[int, list[pa.RecordBatch]]) -> _LeftBlock:
        block = _LeftBlock(parts, k)
        for kind in (_LEFT, _SKIP, _FIXED):
            parts[kind] = []
        return block

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(left: np.ndarray, right: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
            columns = {"left_id": pa.array(left), "right_id": pa.array(right), "score": pa.array(scores)}
            if nonzero:
                columns["nonzero"] = pa.nulls(len(left), pa.int64())
            return pa.RecordBatch.from_pydict(columns)

        parts: dict[int, list[pa.RecordBatch]] = {_LEFT: [], _SKIP: [], _FIXED: [], _RIGHT: []}
        block, held, entries = None, 0, 0
        for batch in batches:
            kind = batch["kind"].to_numpy()
            edges = np.searchsorted(kind, np.arange(_RIGHT + 2))
            for which, low, high in zip(range(_RIGHT + 1), edges, edges[1:]):
                if high > low:
                    parts[which].append(batch.slice(low, high - low))
            if edges[_RIGHT + 1] > edges[_RIGHT]:
                held += len(parts[_RIGHT][-1])
                entries += len(parts[_RIGHT][-1]["key"].flatten())
            if held >= plan.right_ids or entries >= plan.entries:
                block = block or taken(parts)
                multiply(block, parts[_RIGHT])
                parts[_RIGHT], held, entries = [], 0, 0
                if k is None:
                    row, right, scores = block.cut()
                    yield rows(block.ids[row], right, scores)
        if held or block:
            block = block or taken(parts)
            if held:
                multiply(block, parts[_RIGHT])
            row, right, scores = block.cut()
            yield rows(block.ids[row], right, scores)
            if nonzero:
                n = len(block.ids)
                columns = {"left_id": pa.array(block.ids), "right_id": pa.nulls(n, pa.int64()), "score": pa.nulls(n, pa.float64())}
                yield pa.RecordBatch.from_pydict(columns | {"nonzero": pa.array(block.counted)})

    return kernel


def blocked_topk(
    left: DataFrame,
    right: DataFrame,
    k: int,
    *,
    candidates: DataFrame | None = None,
    skip: DataFrame | None = None,
    skip_self: bool = False,
    score: Score = DOT,
    digits: int = 6,
    plan: BlockPlan = BlockPlan(),
) -> DataFrame:
    """Best ``k`` right ids per left id: ``(left_id, right_id, score, rank)``.

    Every right id is a candidate, and so is every ``id`` of ``candidates``; one that shares no
    feature scores 0. Scores are rounded before they are ranked and ties go to the lower id, so
    the result does not depend on the order in which sums are formed. ``skip`` holds pairs
    ``(id, key)`` that must not be returned. Inputs are read several times: pass staged tables.
    """
    found = _blocked(left, right, k, candidates, skip, skip_self, score, digits, plan)
    return top_per_group(found, "left_id", [F.desc("score"), "right_id"], k)


def nearest_topk(left: DataFrame, right: DataFrame, k: int, *, digits: int = 6, plan: BlockPlan = BlockPlan()) -> DataFrame:
    """The part of ``blocked_topk(.., skip_self=True)`` with a score other than 0, for left ids that are right ids too.

    Pairs of score 0 stand between positive and negative ones, and only their number matters. So no such pair is formed: a task
    counts its left ids' scores other than 0, and the rest of all right ids has score 0.
    """
    found = stage_alone(lambda: _blocked(left, right, k, None, None, True, DOT, digits, plan, nonzero=True), "nearest")
    others = right.select("id").distinct().count() - 1
    counts = found.filter("nonzero IS NOT NULL").groupBy("left_id").agg((F.lit(others) - F.sum("nonzero")).alias("_zeros"))
    best = top_per_group(found.filter("nonzero IS NULL").drop("nonzero"), "left_id", [F.desc("score"), "right_id"], k)
    placed = best.join(counts, "left_id")
    rank = F.col("rank") + F.when(F.col("score") < 0, F.col("_zeros")).otherwise(F.lit(0))
    return placed.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).drop("_zeros")


def blocked_matrix(
    left: DataFrame,
    right: DataFrame,
    *,
    skip_self: bool = False,
    digits: int = 9,
    plan: BlockPlan = BlockPlan(),
) -> DataFrame:
    """All non-zero scores ``(left_id, right_id, score)``, each formed whole in its block pair.

    The result is the product matrix itself; use ``blocked_topk`` wherever the best k suffice.
    Rounding turns the dust of cancelled sums into true zeros.
    """
    return _blocked(left, right, None, None, None, skip_self, DOT, digits, plan)


def _blocked(
    left: DataFrame,
    right: DataFrame,
    k: int | None,
    candidates: DataFrame | None,
    skip: DataFrame | None,
    skip_self: bool,
    score: Score,
    digits: int,
    plan: BlockPlan,
    nonzero: bool = False,
) -> DataFrame:
    spark: SparkSession = left.sparkSession
    lside = measure(left, plan)
    rside = lside if right is left else measure(right, plan)
    lblocks, at_once, slices = _rounds(lside, rside, plan, spark.sparkContext.defaultParallelism)
    lb, piece = block_of("id", lblocks).alias("lb"), block_of("key", slices).alias("slice")
    own = block_of("id", slices).alias("slice")

    fixed, short_left, short_right = None, left, right
    if lside.has_long or rside.has_long:
        def long_ids(rows: DataFrame) -> DataFrame:
            n = F.count("*").alias("_n")
            return rows.groupBy("id").agg(n).filter(F.col("_n") > plan.long_row).select("id")

        long_left, long_right = stage(long_ids(left), "long"), stage(long_ids(right), "long")
        short_left = left.join(long_left, "id", "left_anti")
        short_right = right.join(long_right, "id", "left_anti")
        fixed = stage(_packed(_long_scores(left, right, long_left, long_right, score), piece, most=plan.long_row), "fixed")
    if skip is not None:
        pairs = skip.select("id", "key", F.lit(0.0).alias("weight"))
        skip = stage(_packed(pairs, piece, most=plan.long_row), "skip")

    def rows(entries: DataFrame) -> DataFrame:
        return _packed(entries.select("id", F.col("feature").alias("key"), "weight"), most=plan.long_row)

    def with_ids(packed: DataFrame, ids: DataFrame) -> DataFrame:
        """Ids without a short row too, as rows without entries."""
        nothing = F.array().cast("array<bigint>"), F.array().cast("array<double>")
        joined = ids.select("id").distinct().join(packed, "id", "left")
        return joined.select("id", F.coalesce("key", nothing[0]).alias("key"), F.coalesce("weight", nothing[1]).alias("weight"))

    rids = right.select("id")
    if candidates is not None:
        rids = rids.unionByName(candidates.select("id"))
    lefts = rows(short_left) if short_left is left else with_ids(rows(short_left), left)
    lefts = stage(lefts, "left_rows")
    same = right is left and candidates is None
    rights = lefts if same else rows(short_right)
    if not same and (candidates is not None or short_right is not right):
        rights = with_ids(rights, rids)
    rights = lefts if same else stage(rights, "right_rows")

    def product(first: int, last: int) -> DataFrame:
        """Left blocks first to last - 1 against all right rows."""
        mine = F.col("lb").between(first, last - 1)
        place = (F.col("lb") - F.lit(first)) * F.lit(slices) + F.col("slice")
        every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
        every_block = F.explode(F.sequence(F.lit(first), F.lit(last - 1))).alias("lb")
        parts = [
            (lefts.select("*", lb).filter(mine).select("*", every_slice), _LEFT),
            (rights.select("*", own).select("*", every_block), _RIGHT),
        ]
        parts += [(pairs.select("*", lb).filter(mine), kind) for pairs, kind in ((skip, _SKIP), (fixed, _FIXED)) if pairs is not None]
        sent = [rows.withColumns({"part": place.cast("int"), "kind": F.lit(kind)}).select(*_SHIPPED) for rows, kind in parts]
        shipped = sent[0]
        for more in sent[1:]:
            shipped = shipped.unionByName(more)
        # One task per left block and slice.
        spread = shipped.repartitionById((last - first) * slices, "part").sortWithinPartitions("kind", "id")
        schema = "left_id bigint, right_id bigint, score double" + (", nonzero bigint" if nonzero else "")
        return spread.select("kind", "id", "key", "weight").mapInArrow(_block_kernel(k, digits, score, skip_self, plan, nonzero), schema)

    if at_once >= lblocks:
        return product(0, lblocks)
    done: DataFrame | None = None
    for first in range(0, lblocks, at_once):
        found = stage(product(first, min(lblocks, first + at_once)), "found")
        done = found if done is None else done.unionByName(found)
    return done


def unit_rows(rows: DataFrame) -> DataFrame:
    """Rows scaled to length one; a zero row stays zero, its cosine with anything is 0."""
    norms = rows.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"))
    return _scaled(rows.join(norms, "id"), F.col("_norm"))


def unit_short_rows(rows: DataFrame) -> DataFrame:
    """As ``unit_rows`` in one pass, for ids with a bounded number of features (a vocabulary)."""
    return _scaled(rows, F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("id"))))


def _scaled(rows: DataFrame, norm: Column) -> DataFrame:
    scaled = F.coalesce(F.try_divide(F.col("weight"), norm), F.lit(0.0))
    return rows.select("id", "feature", scaled.alias("weight"))


def cosine_topk(rows: DataFrame, k: int, plan: BlockPlan = BlockPlan(), wanted: DataFrame | None = None) -> DataFrame:
    """The ``k`` most similar other ids per id; pairs of similarity 0 are not returned.

    ``wanted`` (id) restricts the left side before any product is formed.
    """
    unit = stage(unit_rows(rows), "unit")
    left = unit if wanted is None else stage(unit.join(wanted, "id", "left_semi"), "wanted_unit")
    return nearest_topk(left, unit, k, plan=plan)


def cosine_matrix(rows: DataFrame, plan: BlockPlan = BlockPlan()) -> DataFrame:
    """Every non-zero cosine between two different ids."""
    unit = stage(unit_rows(rows), "unit")
    return blocked_matrix(unit, unit, skip_self=True, plan=plan)
