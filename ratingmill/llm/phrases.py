"""Phrase collocation mining with counting quotient filters.

1. Texts of a language are cut into pieces and words and kept as chunks of local word numbers, each with its dictionary. The
   dictionaries alone are shuffled: they give all word counts, and the numbers of the words that are frequent enough for a phrase.
2. Phrases are counted length by length. A phrase of k words is packed into one integer, the number of its first k - 1 words and that of
   its last word, and only where both of its parts of k - 1 words are frequent (no phrase is more frequent than its parts, so none is
   lost). Each chunk counts its packed phrases in a counting quotient filter per shard; filters of a shard are merged sorted, and the
   shard answers each chunk which of its entries are frequent and under which number.
3. Frequent phrases become words again by joins of their numbers; cuts, scores and the containment rule are SQL over the frequent
   phrases of all lengths. A phrase in a longer one of equal count is also in one that is a word longer, so only those are compared.

A hot word or phrase is one filter entry per chunk. Joins on words are joined where they lie if a word is in very many chunks.

Defined cases: null and empty texts have no words; a null lang is ``und``; repeated rows count as often; words are bytes other than
space and tab within a piece, A-Z folded; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.llm import quotient_filter as Q
from ratingmill.llm.hot_keys import join_counted, look_up
from ratingmill.operators.ranking import top_per_group, with_position
from ratingmill.session import stage, unstage

LEAST = 100
LONGEST = 5
TOP = 2000
CHUNK_BYTES = 1 << 24
PART_BYTES = 1 << 20
SHARD_ENTRIES = 1 << 20
UNKNOWN = "und"

# A-Z fold, .,;:!? and 0x0A-0x0D end a piece and become a full stop, tab becomes a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A translated text in parts of about ``size`` bytes, cut between pieces only."""
    low = 0
    while low < len(text):
        cut = text.find(b".", low + size)
        high = len(text) if cut < 0 else cut
        yield text[low:high]
        low = high + 1


class _Chunk:
    """Local word numbers of the texts of a language (0: end of a piece), the words, and how often each stands."""

    def __init__(self):
        self.numbers = {b".": 0}
        self.found: list[np.ndarray] = []
        self.waiting: list[bytes] = []
        self.size = 0

    def add(self, part: bytes) -> None:
        self.waiting.append(part)
        self.size += len(part)
        if self.size >= PART_BYTES:
            self.flush()

    def flush(self) -> None:
        numbers = self.numbers
        tokens = (b".".join(self.waiting) + b".").replace(b".", b" . ").split()
        self.found.append(np.array([numbers.setdefault(t, len(numbers)) for t in tokens], np.int32))
        self.waiting, self.size = [], 0

    def row(self, lang: str) -> tuple:
        self.flush()
        found = np.concatenate(self.found)
        return lang, Q.pack(found), list(self.numbers)[1:], np.bincount(found, minlength=len(self.numbers))[1:]


_CHUNKS = "lang string, tokens binary, words array<binary>, counts array<bigint>"


def _chunks(size: int):
    kinds = [pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]

    def emitted(held: dict[str, _Chunk]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(chunk.row(lang), kinds)], ["lang", "tokens", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Chunk] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                for part in _parts((text or b"").translate(_TABLE), PART_BYTES):
                    held.setdefault(lang, _Chunk()).add(part)
                    total += len(part)
                    if total >= size:
                        yield from emitted(held)
                        held, total = {}, 0
        yield from emitted(held)

    return run


def _renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Local word numbers replaced by those of the frequent words, 0 for all others."""
    for batch in batches:
        for row in range(batch.num_rows):
            tokens = Q.unpack(batch.column("tokens")[row].as_py(), np.int32)
            names = batch.column("names")[row].values
            number = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
            number[names.field("local").to_numpy()] = names.field("id").to_numpy()
            words, grams = pa.array([Q.pack(number[tokens])], pa.binary()), pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("chunk").slice(row, 1), words, grams], ["chunk", "words", "grams"])


def _keys(words: bytes, grams: bytes | None, length: int, word_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of a chunk, where its candidate phrases start, and their packed keys. Without ``grams`` the words are the heads."""
    numbers = Q.unpack(words, np.int64)
    heads = numbers if grams is None else Q.unpack(grams, np.int64)
    at = np.flatnonzero((heads[:-1] > 0) & (heads[1:] > 0)) if len(heads) else np.zeros(0, np.int64)
    packed = heads[at].astype(np.uint64) << np.uint64(word_bits) | numbers[at + length - 1].astype(np.uint64)
    return numbers, at, packed


def _bounds(keys: np.ndarray, bits: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards of sorted permuted keys and where each begins, with the end of the last."""
    shards = (keys >> np.uint64(bits - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(keys), np.int64)
    found = np.unique(shards)
    return found, np.append(np.searchsorted(shards, found), len(keys))


def _filters(length: int, word_bits: int, bits: int, shard_bits: int):
    """chunk, shard, filter: the phrases of ``length`` words of each chunk."""
    permuted = Q.Permutation(bits)
    inside = np.uint64((1 << (bits - shard_bits)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, grams in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words", "grams"))):
                keys, counts = Q.counted(np.sort(permuted(_keys(words, grams, length, word_bits)[2])))
                shards, begin = _bounds(keys, bits, shard_bits)
                filters = [Q.encode(keys[a:b] & inside, counts[a:b], bits - shard_bits) for a, b in zip(begin, begin[1:])]
                columns = [pa.array(np.full(len(shards), chunk)), pa.array(shards), pa.array(filters, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "shard", "filter"])

    return run


_MERGED = "chunk bigint, shard bigint, known binary, places binary, heads array<bigint>, lasts array<bigint>, counts array<bigint>"


def _merged(least: int, word_bits: int, bits: int, shard_bits: int):
    """The frequent phrases of a shard, and for each of its chunks the bits of its entries that are among them, with their places as gaps."""
    permuted = Q.Permutation(bits)

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        filters = [Q.decode(f, bits - shard_bits) for f in table["filter"].to_pylist()]
        keys, counts = Q.merge(filters)
        use = counts >= least
        keys, counts = keys[use], counts[use]
        whole = permuted.inverse(keys | np.uint64(shard << (bits - shard_bits)))
        out = [(None, shard, None, None, (whole >> np.uint64(word_bits)).astype(np.int64), (whole & np.uint64((1 << word_bits) - 1)).astype(np.int64), counts)]
        for chunk, (own, _) in zip(table["chunk"].to_pylist(), filters):
            place = np.searchsorted(keys, own)
            known = place < len(keys)
            known[known] = keys[place[known]] == own[known]
            if known.any():
                # Entries are sorted as the phrases are, so places only rise.
                gaps = np.diff(place[known], prepend=-1) - 1
                out.append((chunk, shard, Q.pack(np.packbits(known)), Q.pack(gaps), None, None, None))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 3]
        names = ["chunk", "shard", "known", "places", "heads", "lasts", "counts"]
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, zip(*out), kinds)})

    return run


def _advanced(length: int, word_bits: int, bits: int, shard_bits: int):
    """Chunks with the numbers of the frequent phrases of ``length`` words at their starts, cut to where a longer one may be."""
    permuted = Q.Permutation(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, grams, replies in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words", "grams", "replies"))):
                numbers, at, packed = _keys(words, grams, length, word_bits)
                every = permuted(packed)
                keys = np.unique(every)
                shards, begin = _bounds(keys, bits, shard_bits)
                ids = np.zeros(len(keys), np.int64)
                for reply in replies:
                    own = int(np.searchsorted(shards, reply["shard"]))
                    here = ids[begin[own] : begin[own + 1]]
                    place = np.cumsum(Q.unpack(reply["places"], np.int64) + 1) - 1
                    here[np.unpackbits(Q.unpack(reply["known"], np.uint8), count=len(here)) == 1] = (place << shard_bits | reply["shard"]) + 1
                found = np.zeros(len(numbers), np.int64)
                found[at] = ids[np.searchsorted(keys, every)]
                both = np.flatnonzero((found[:-1] > 0) & (found[1:] > 0))
                used, kept = np.zeros((2, len(found)), bool)
                used[both] = used[both + 1] = True
                for k in range(length + 1):
                    kept[both + k] = True
                # What follows a run is not part of a phrase, so the last kept starts hold 0 and part it from the next run.
                columns = [pa.array([chunk]), *(pa.array([Q.pack(x[kept])], pa.binary()) for x in (numbers, np.where(used, found, 0)))]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "words", "grams"])

    return run


def _count_phrases(state: DataFrame, length: int, head_bits: int, word_bits: int, positions: int, least: int, shard_entries: int, go_on: bool):
    """The frequent phrases of ``length`` words (id, head, last, f), the next state (None unless ``go_on``) and the width of an id.

    ``state`` is deleted.
    """
    shard_bits = max(0, (positions // shard_entries).bit_length())
    bits = max(head_bits + word_bits, shard_bits + 1)
    if bits > 64:
        raise ValueError(f"{bits} bits for a packed phrase, 64 at most")
    built = state.mapInArrow(_filters(length, word_bits, bits, shard_bits), "chunk bigint, shard bigint, filter binary")
    merged = stage(built.groupBy("shard").applyInArrow(_merged(least, word_bits, bits, shard_bits), _MERGED), "phrases")
    tables = merged.filter("chunk IS NULL")
    entry = F.posexplode(F.arrays_zip("heads", "lasts", "counts")).alias("place", "entry")
    number = (F.shiftleft(F.col("place").cast("bigint"), shard_bits).bitwiseOR(F.col("shard")) + 1).alias("id")
    found = tables.select("shard", entry).select(
        number, F.col("entry.heads").alias("head"), F.col("entry.lasts").alias("last"), F.col("entry.counts").alias("f")
    )
    found = stage(found, "found")
    deepest = tables.agg(F.coalesce(F.max(F.size("heads")), F.lit(0))).first()[0]
    after = None
    if go_on:
        after = _next_state(state, merged, _advanced(length, word_bits, bits, shard_bits))
    unstage(merged)
    unstage(state)
    return found, after, (max(1, deepest) << shard_bits).bit_length()


def _next_state(state: DataFrame, merged: DataFrame, advanced) -> DataFrame:
    replies = merged.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("shard", "known", "places")).alias("replies"))
    return stage(state.join(replies, "chunk").mapInArrow(advanced, "chunk bigint, words binary, grams binary"), "state")


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk_bytes: int = CHUNK_BYTES, shard_entries: int = SHARD_ENTRIES
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences (lang, phrase, size, f), and the words per lang (lang, n)."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text"))
    chunks = texts.mapInArrow(_chunks(chunk_bytes), _CHUNKS).withColumn("chunk", F.monotonically_increasing_id())
    chunks = stage(chunks, "chunks")
    entries = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "entry"))
    entries = entries.select("chunk", "lang", (F.col("pos") + 1).alias("local"), F.col("entry.words").alias("word"), F.col("entry.counts").alias("c"))
    words = stage(entries.groupBy("lang", "word").agg(F.sum("c").alias("f"), F.count("*").alias("n")), "vocabulary")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    positions, rows = words.agg(F.coalesce(F.sum("f"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Frequent words get low numbers, which take few bytes.
    frequent = stage(with_position(words.filter(F.col("f") >= least), [F.desc("f"), "lang", "word"], "id"), "frequent")
    named = join_counted(entries.drop("c"), frequent.select("lang", "word", "n", "id"), ["lang", "word"], rows, how="left")
    name = F.when(F.col("id").isNotNull(), F.struct("local", "id"))
    # Written alone, so that the look-up's shuffle files are gone when the chunks are shuffled.
    names = stage(named.groupBy("chunk").agg(F.collect_list(name).alias("names")).filter(F.size("names") > 0), "names")
    # The dictionaries are not needed any more.
    tokens = stage(chunks.select("chunk", "tokens"), "tokens")
    unstage(chunks)
    state = tokens.join(names, "chunk").mapInArrow(_renamed, "chunk bigint, words binary, grams binary")
    state = stage(state, "numbers")
    unstage(tokens)
    unstage(names)
    word_bits = head_bits = max(1, frequent.count().bit_length())
    shown = frequent.select("id", "lang", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("size"), "f")
    phrases, spoken = shown, shown.select(F.col("id").alias("last"), F.col("phrase").alias("word"))
    for length in range(2, longest + 1):
        found, state, head_bits = _count_phrases(state, length, head_bits, word_bits, positions, least, shard_entries, length < longest)
        heads = shown.select(F.col("id").alias("head"), "lang", "phrase")
        begun = stage(look_up(found, heads, ["head"]), "begun")
        full = look_up(begun, spoken, ["last"])
        text = F.concat_ws(" ", "phrase", "word").alias("phrase")
        shown = stage(full.select("id", "lang", text, F.lit(length).alias("size"), "f"), "shown")
        phrases = phrases.unionByName(shown)
    return phrases.drop("id"), totals


def _ratio(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) over integers of up to 38 digits."""

    def wide(x: Column) -> Column:
        return x.cast("decimal(19,0)")

    top = (wide(a) * wide(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    # F has no integral division.
    return F.call_function("div", top, wide(left) * wide(right)).cast("bigint")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
    shard_entries: int = SHARD_ENTRIES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two words or more of each lang."""
    phrases, totals = frequent_phrases(docs, least, longest, chunk_bytes, shard_entries)
    phrases = stage(phrases, "phrases")
    candidates = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))
    inner = F.explode(
        F.array(F.array_join(F.expr("slice(words, 1, size - 1)"), " "), F.array_join(F.expr("slice(words, 2, size - 1)"), " "))
    ).alias("phrase")
    longer = candidates.filter("size > 2").select("lang", inner, "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < f").drop("longer")
    kept = kept.join(totals, "lang")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "n", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "n", "cut",
        F.array_join(F.expr("slice(words, 1, cut)"), " ").alias("first"),
        F.array_join(F.expr("slice(words, cut + 1, size(words) - cut)"), " ").alias("rest"),
    )
    counts = phrases.select("lang", "phrase", "f")
    cuts = look_up(stage(cuts, "cuts"), counts.withColumnsRenamed({"phrase": "first", "f": "l"}), ["lang", "first"])
    cuts = look_up(stage(cuts, "cuts"), counts.withColumnsRenamed({"phrase": "rest", "f": "r"}), ["lang", "rest"])
    score = _ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score, "cut", "l", "r")).alias("best"))
    scored = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    ranked = top_per_group(scored, "lang", [F.desc("score"), F.desc("a"), "phrase"], top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
