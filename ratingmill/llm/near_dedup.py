"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct five-word shingles. Register i is ``floor(1 - log_b(m_i))`` truncated to 0..q+1, where
m_i is the smallest of independent exponential values of the shingles: exponentially spaced minima, mergeable by maximum,
whose equality has about the probability of the Jaccard similarity. Bands of registers propose groups; a group links its
members to its smallest one, and the connected proposals are settled exactly: inside a proposal the joint likelihood of two
sketches (counts of greater, smaller and equal registers, given both set sizes) drops unlikely partners, and every link is
confirmed on the full shingle sets. Twenty bands of three registers miss a pair at similarity 0.85 with probability 5e-9.

Hot groups: equal sets collapse to one representative before anything is compared. A proposal is settled by growing
clusters from a member: what is reached is not compared again, so a dense group costs one comparison or few per member. A
proposal beyond ``PACK_SHINGLES`` is cut into chunks; the chunks' leaders are clustered again, level by level, and members
that are still outside the proposal's largest cluster are compared with every chunk, so no link is lost.

Defined cases: null, empty and wordless texts have an empty set and are linked with nothing; fewer than five words are
one shingle; equal texts are linked; a null doc_id is linked to its group but never stands for it; several texts under one
doc_id count as that document's smallest set in comparisons; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.llm import words as W
from ratingmill.llm.components import components
from ratingmill.session import stage

BANDS, ROWS = 20, 3
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65534
LINK = 85  # per cent
MARGIN = 0.25  # of the likelihood estimate below the threshold; five standard errors
PACK_SHINGLES = 400_000

_SEEDS = np.random.default_rng(5).integers(1, 2**63, (2, REGISTERS), dtype=np.uint64)
SKETCH = "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, registers binary, bands array<bigint>"


def registers(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row of registers per nonempty set."""
    out = np.empty((len(begin), REGISTERS), np.uint16)
    for i in range(REGISTERS):
        x = values ^ _SEEDS[0, i]
        x *= _SEEDS[1, i] | np.uint64(1)
        x ^= x >> np.uint64(32)
        least = np.minimum.reduceat(x, begin)
        value = -np.log1p(-((least >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP + 1)
    return out


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sketch ``a`` with each row of ``b``, on a grid of 41 values."""
    greater, smaller = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 41)[None, :] * np.minimum(u / v, v / u)
    chance = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = chance(u - v * j), chance(v - u * j)
    same = np.maximum(1 - up - down, 1e-12)
    likelihood = greater * np.log(up) + smaller * np.log(down) + (a.shape[-1] - greater - smaller) * np.log(same)
    return j[np.arange(len(j)), likelihood.argmax(1)]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, at in W.chunks(batch):
            values, begin = W.shingle_sets(data, at)
            n = np.diff(begin)
            full = np.flatnonzero(n)
            regs = np.zeros((len(n), REGISTERS), np.uint16)
            f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(full):
                regs[full] = registers(values, begin[full])
                f1[full] = np.add.reduceat(values, begin[full])
                f2[full] = np.add.reduceat(W.mixed(values ^ np.uint64(0x5851F42D4C957F2D)), begin[full])
            bands = np.empty((len(n), BANDS), np.uint64)
            for k in range(BANDS):
                key = np.full(len(n), k + 1, np.uint64)
                for r in range(ROWS):
                    key = W.mixed(key * np.uint64(0x9E3779B97F4A7C15) + regs[:, k * ROWS + r])
                bands[:, k] = key
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(W.signed(f1)),
                    pa.array(W.signed(f2)),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), pa.array(W.signed(bands.ravel()))),
                ],
                ["doc_id", "n_shingles", "f1", "f2", "registers", "bands"],
            )


class _Members:
    """The full sets and sketches of the members of one pack."""

    def __init__(self, rows: pa.Table, link: int):
        rows = rows.combine_chunks()
        self.link = link
        self.ids = rows["doc_id"].to_numpy()
        self.regs = np.frombuffer(b"".join(rows["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        values, begin, base = [], [np.zeros(1, np.int64)], 0
        for batch in rows.select(["text"]).to_batches():
            for _, data, at in W.chunks(batch):
                own, first = W.shingle_sets(data, at)
                values.append(own)
                begin.append(first[1:] + base)
                base += len(own)
        self.values, self.begin = np.concatenate(values), np.concatenate(begin)
        self.n = np.diff(self.begin)

    def linked(self, one: int, rest: np.ndarray) -> np.ndarray:
        """Which members of ``rest`` are linked with ``one``, confirmed on the full sets."""
        n1, n2 = self.n[one], self.n[rest]
        rest = rest[np.minimum(n1, n2) * 100 >= np.maximum(n1, n2) * self.link]
        if not len(rest):
            return rest
        likely = joint_estimate(self.regs[one], self.regs[rest], np.float64(n1), self.n[rest].astype(float))
        rest = rest[likely >= self.link / 100 - MARGIN]
        if not len(rest):
            return rest
        mine = self.values[self.begin[one] : self.begin[one + 1]]
        n2 = self.n[rest]
        first = np.cumsum(n2) - n2
        theirs = self.values[np.repeat(self.begin[rest], n2) + np.arange(n2.sum()) - np.repeat(first, n2)]
        where = np.searchsorted(mine, theirs)
        where[where == len(mine)] = 0
        shared = np.add.reduceat((mine[where] == theirs).astype(np.int64), first)
        return rest[shared * 100 >= (n1 + n2 - shared) * self.link]


def _clusters(members: _Members, among: np.ndarray) -> np.ndarray:
    """Smallest doc_id of each member's cluster; ``among`` holds the members of one chunk by doc_id."""
    label = np.zeros(len(among), np.int64)
    place = {int(m): k for k, m in enumerate(among)}
    left = among
    while len(left):
        root, left = left[0], left[1:]
        grow = [root]
        while grow:
            one = grow.pop()
            label[place[int(one)]] = members.ids[root]
            if len(left):
                got = members.linked(one, left)
                if len(got):
                    left = left[~np.isin(left, got, assume_unique=True)]
                    grow.extend(got)
    return label


def _runs(rows: pa.Table) -> Iterator[np.ndarray]:
    """Row numbers of each (component, chunk), by doc_id; a repeated doc_id counts once."""
    comp, chunk, ids = (rows[c].to_numpy() for c in ("component", "chunk", "doc_id"))
    order = np.lexsort((ids, chunk, comp))
    same = (comp[order][1:] == comp[order][:-1]) & (chunk[order][1:] == chunk[order][:-1])
    for run in np.split(order, np.flatnonzero(~same) + 1):
        yield run[np.concatenate(([True], ids[run][1:] != ids[run][:-1]))]


def _clustered(link: int):
    def run(rows: pa.Table) -> pa.Table:
        members = _Members(rows, link)
        ids, comps, labels = [], [], []
        for among in _runs(rows):
            ids.append(members.ids[among])
            comps.append(rows["component"].to_numpy()[among])
            labels.append(_clusters(members, among))
        return pa.table({"doc_id": np.concatenate(ids), "component": np.concatenate(comps), "label": np.concatenate(labels)})

    return run


def _probed(link: int):
    """Links between visiting members and a chunk's residents of another cluster: one per pair of clusters."""

    def run(rows: pa.Table) -> pa.Table:
        members = _Members(rows, link)
        label, visits = rows["label"].to_numpy(), rows["visits"].to_numpy(zero_copy_only=False)
        found = set()
        resident = np.flatnonzero(~visits)
        for one in np.flatnonzero(visits):
            known = {b for a, b in found if a == label[one]}
            rest = resident[(label[resident] != label[one]) & ~np.isin(label[resident], list(known))]
            found |= {(int(label[one]), int(label[k])) for k in members.linked(one, rest)}
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _chunked(members: DataFrame, pack: int) -> DataFrame:
    """Members with chunks (of their component), chunk and pack; small components share a pack."""
    load = members.groupBy("component").agg(F.sum("n_shingles").alias("_load"))
    total = load.agg(F.sum("_load").alias("t")).first()["t"] or 0
    packs = max(1, -(-2 * total // pack))
    chunks = F.ceil(F.col("_load") / pack).cast("bigint")
    spread = F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    out = members.join(load, "component").withColumn("chunks", chunks).withColumn("chunk", spread)
    own = F.xxhash64("component", "chunk")
    return out.withColumn("pack", F.when(F.col("chunks") > 1, own).otherwise(F.pmod(own, F.lit(packs)))).drop("_load")


def _settled(members: DataFrame, link: int, pack: int) -> DataFrame:
    """doc_id, label: clusters of the members (doc_id, component, n_shingles, registers, text)."""
    members = stage(_chunked(members, pack), "members")
    result = stage(members.groupBy("pack").applyInArrow(_clustered(link), "doc_id bigint, component bigint, label bigint"), "clusters")
    large = members.filter("chunks > 1").select("component").distinct()
    if large.isEmpty():
        return result.select("doc_id", "label")
    large = stage(large, "large")
    leaders = result.join(large, "component", "left_semi").select(F.col("label").alias("doc_id")).distinct()
    before = None
    while True:
        level = stage(_chunked(members.join(leaders, "doc_id", "left_semi").drop("chunks", "chunk", "pack"), pack), "leaders")
        n = level.count()
        if n == before:
            break
        before = n
        merged = stage(level.groupBy("pack").applyInArrow(_clustered(link), "doc_id bigint, component bigint, label bigint"), "merged")
        up = merged.select(F.col("doc_id").alias("label"), F.col("label").alias("_up"))
        result = stage(result.join(up, "label", "left").select("doc_id", "component", F.coalesce("_up", "label").alias("label")), "clusters")
        if level.filter("chunks > 1").isEmpty():
            break
        leaders = merged.select(F.col("label").alias("doc_id")).distinct()
    here = members.join(large, "component", "left_semi").join(result.select("doc_id", "label"), "doc_id")
    counts = here.groupBy("component", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("component").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    cols = ["component", "chunk", "doc_id", "n_shingles", "registers", "text", "label"]
    outside = here.join(main, "component").filter("label <> main")
    visitors = outside.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))).select(*cols, F.lit(True).alias("visits"))
    probes = here.select(*cols, F.lit(False).alias("visits")).unionByName(visitors)
    links = components(probes.groupBy("component", "chunk").applyInArrow(_probed(link), "a bigint, b bigint"))
    links = links.select(F.col("node").alias("label"), F.col("component").alias("_root"))
    return result.join(links, "label", "left").select("doc_id", F.coalesce("_root", "label").alias("label"))


def near_dedup(docs: DataFrame, link: int = LINK, pack: int = PACK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Documents are linked when 100 * intersection >= ``link`` * union of their shingle sets; ``link`` is at least 80.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    sketched = stage(narrow.mapInArrow(_sketches, SKETCH), "sketches")
    same = ["f1", "f2", "n_shingles"]
    groups = stage(sketched.filter("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep")), "groups")
    reps = sketched.join(groups.withColumn("doc_id", F.col("rep")), [*same, "doc_id"], "left_semi")
    keys = reps.select("doc_id", F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).filter("head < last").select("key", "head")
    proposed = components(keys.join(heads, "key").filter("doc_id > head").select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    proposed = stage(proposed.withColumnRenamed("node", "doc_id"), "proposed")
    chosen = sketched.join(groups.withColumn("doc_id", F.col("rep")), [*same, "doc_id"], "left_semi").select("doc_id", "n_shingles", "registers")
    chosen = chosen.join(proposed, "doc_id").groupBy("doc_id", "component").agg(F.min(F.struct("n_shingles", "registers")).alias("s"))
    members = chosen.select("doc_id", "component", "s.*").join(narrow, "doc_id")
    labels = _settled(members, link, pack).distinct()
    named = groups.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left")
    named = named.select(*same, F.coalesce("label", "rep").alias("component_id"))
    out = sketched.select("doc_id", *same).join(named, same, "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
