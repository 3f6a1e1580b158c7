"""Toxicity by class-conditional word models (bigrams that back off, with discounts by chance instead of Kneser-Ney's).

Two bigram models, of toxic and of ordinary documents, are trained on labelled rows. Counts of a class are discounted to what
exceeds chance. A class bigram backs off to the class's own unigrams, and those back off to counts that both classes share
(what both have, plus continuation counts: in how many classes a word stands, not how often), so that an expression that is
rare, or no more frequent in one class than chance allows, has the same probability in both. Copies of a text, and what a text
repeats, count once. The score of a text is a logistic function of the difference between its two
log-likelihoods, normalised by its length (over the root of the number of words, as chance differences add up to that; the
mean per word makes short texts uncertain); the function is fitted on labelled rows that the models have not seen.

Training bound: ``SAMPLE`` labelled rows per class and no more than the rarer class has, so that both models are as sharp; those
with the smallest hash of the doc_id; a quarter of them only fits
the logistic function. Only words and pairs whose counts may exceed chance are sent to the tasks. Every text is scored whole.

Defined cases: null and empty texts have no words and score the prior; rows whose label or doc_id is null train nothing;
without a labelled row of either class the score is the share of toxic labels (0 without labels); rows that repeat a doc_id
are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.llm import words as W
from ratingmill.session import stage

SAMPLE = 4000
DISCOUNT, PAIR_DISCOUNT = 2.5, 5.0  # standard errors
CONTINUATION = 0.5
_START, _ALONE = np.uint64(0x1F123BB5159A55E5), np.uint64(0x4D5A2DA51DE1AA47)


def _pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return W.mixed(before * np.uint64(0x9E3779B97F4A7C15) ^ words)


def _with_before(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first[:-1][np.diff(first) > 0]] = _START
    return before


def _discounted(counts: np.ndarray, totals: np.ndarray, errors: float) -> np.ndarray:
    """What each class's counts keep of their own: the excess over the other class's share, less some standard errors.

    A discount that grows with the count takes all of a rare expression's counts, and of those that only differ by chance.
    """
    common = (counts / totals).min(1)[:, None] * totals
    return np.maximum(counts - common - errors * np.sqrt(counts), 0)


class Model:
    """Both class models as lookup tables, and the logistic function of the length-normalised difference."""

    def __init__(self, words: np.ndarray, n: np.ndarray, totals: np.ndarray, rates: float, stands: int, pairs: tuple, held: tuple):
        """Words with counts ``n`` by class (columns ordinary, toxic) that may keep some; of all words the counts ``totals`` by
        class, the sum of the smaller rates and the sum of the classes they stand in; pairs (before, word, counts, totals) that
        may keep some; their words before with counts by class."""
        # Shared counts: what both classes have, plus a share of a word's continuation count, the number of classes it stands in.
        mean = totals.mean()
        shared = (n / totals).min(1) * mean + CONTINUATION * (n > 0).sum(1)
        whole = rates * mean + CONTINUATION * (stands + 1)
        kept = _discounted(n, totals, DISCOUNT)
        left = 1 - kept.sum(0) / totals
        unigram = kept / totals + left * (shared / whole)[:, None]
        self.unknown = left * CONTINUATION / whole
        before, word, times, all_pairs = pairs
        own = _discounted(times, all_pairs, PAIR_DISCOUNT)
        contexts, context_n = held
        at = np.searchsorted(contexts, before)
        back = 1 - np.stack([np.bincount(at, own[:, k], len(contexts)) for k in (0, 1)], 1) / np.maximum(context_n, 1)
        tables = (words, unigram), (contexts, back), (_pair_keys(before, word), own / np.maximum(context_n, 1)[at])
        self.words, self.contexts, self.pairs = (W.Lookup(keys, rows.astype(np.float32)) for keys, rows in tables)
        self.slope, self.offset = 1.0, 0.0

    def differences(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic minus ordinary log-likelihood over the root of the length, and the number of words, of each text."""
        words, first = W.word_hashes(data, at)
        n = np.diff(first)
        if not len(words):
            return np.zeros(len(n)), n
        before = _with_before(words, first)
        lower = self.words.rows[self.words(words)].astype(np.float64)
        lower[lower[:, 0] == 0] = self.unknown
        back = self.contexts.rows[self.contexts(before)]
        back = np.where(back > 0, back, 1)
        p = self.pairs.rows[self.pairs(_pair_keys(before, words))] + back * lower
        gain = np.concatenate(([0], np.cumsum(np.log(p[:, 1] / p[:, 0]))))
        return (gain[first[1:]] - gain[first[:-1]]) / np.sqrt(np.maximum(n, 1)), n

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        difference, n = self.differences(data, at)
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * difference, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression on one feature, by Newton steps on the scaled feature."""
    scale = x.std() or 1.0
    X = np.stack([x / scale, np.ones(len(x))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        slope = X.T @ (weight * (y - p)) - ridge * beta
        step = np.linalg.solve((X * (weight * p * (1 - p))[:, None]).T @ X + ridge * np.eye(2), slope)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return beta[0] / scale, beta[1]


def clean_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below 0.5. Texts are scored where they are read."""
    model, share = train(docs, labels, sample)
    if model is None:
        return docs.filter(F.lit(share < 0.5))
    sent = W.send(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = W.received(sent)
        for batch in batches:
            for rows, data, at in W.chunks(batch):
                yield rows.filter(pa.array(model.score(data, at) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is kept from training; one without doc_id has no label and counts as held out."""
    name = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.pmod(F.crc32(name), F.lit(5)) == 0, F.lit(True))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words and word pairs of each text: what one text repeats says no more about its class."""
    for batch in batches:
        for rows, data, at in W.chunks(batch):
            words, first = W.word_hashes(data, at)
            before = _with_before(words, first)
            columns: list[list[np.ndarray]] = [[], [], []]
            for k, toxic in enumerate(rows.column("toxic").to_pylist()):
                own = slice(first[k], first[k + 1])
                _, pair = np.unique(_pair_keys(before[own], words[own]), return_index=True)
                alone = np.unique(words[own])
                columns[0].append(np.full(len(pair) + len(alone), toxic, np.int32))
                columns[1] += [before[own][pair], np.full(len(alone), _ALONE)]
                columns[2] += [words[own][pair], alone]
            toxic, before, words = (np.concatenate(c) for c in columns)
            yield pa.RecordBatch.from_arrays([pa.array(toxic), pa.array(W.signed(before)), pa.array(W.signed(words))], ["toxic", "before", "word"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model | None, float]:
    """The fitted model and the share of toxic labels; labels of rows that are held out are not read."""
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("_h", F.xxhash64("doc_id"))
    known = stage(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2:
        return None, share
    chosen, size = None, min(sample, *sizes.values())
    for k in (0, 1):
        some = known.filter(F.col("toxic") == k).orderBy("_h", "doc_id").limit(size)
        chosen = some if chosen is None else chosen.unionAll(some)
    # At most 2 * sample rows of two numbers: small enough to send to every task.
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = stage(texts.select("toxic", "text", (F.pmod("_h", F.lit(4)) == 0).alias("fits")), "sample")
    # Copies of a text count once in a class.
    distinct = texts.filter("NOT fits").select("toxic", "text").distinct()
    counts = distinct.mapInArrow(_counted, "toxic int, before bigint, word bigint").groupBy("before", "word")
    counts = stage(counts.agg(F.count_if(F.col("toxic") == 0).alias("n0"), F.count_if(F.col("toxic") == 1).alias("n1")), "counts")
    alone = F.col("before") == F.lit(int(_ALONE.astype(np.int64)))
    words, pairs = counts.filter(alone), counts.filter(~alone)
    sums = words.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum((F.col("n0") > 0).cast("int") + (F.col("n1") > 0).cast("int")).alias("stands")).first()
    fits = texts.filter("fits").select("toxic", "text").toArrow()
    if not sums["n0"] or not sums["n1"] or len(set(fits["toxic"].to_pylist())) < 2:
        return None, share
    totals = np.array([sums["n0"], sums["n1"]], float)
    rates = words.agg(F.sum(F.least(F.col("n0") / totals[0], F.col("n1") / totals[1])).alias("r")).first()["r"]
    # No count up to the square of the discount keeps anything: such words are as good as unknown.
    may_keep = lambda errors: F.greatest("n0", "n1") > errors**2
    kept_words = words.filter(may_keep(DISCOUNT)).toArrow()
    kept_pairs = stage(pairs.filter(may_keep(PAIR_DISCOUNT)), "pairs")
    held = pairs.join(kept_pairs.select("before").distinct(), "before", "left_semi").groupBy("before").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    all_pairs = pairs.agg(F.coalesce(F.sum("n0"), F.lit(0)).alias("n0"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n1")).first()
    kept_pairs = kept_pairs.toArrow()
    keys = lambda t, c: t[c].to_numpy().view(np.uint64)
    both = lambda t: np.stack([t["n0"].to_numpy(), t["n1"].to_numpy()], 1).astype(float)
    order = np.argsort(keys(held, "before"))
    model = Model(
        keys(kept_words, "word"), both(kept_words), totals, rates, sums["stands"],
        (keys(kept_pairs, "before"), keys(kept_pairs, "word"), both(kept_pairs), np.maximum([all_pairs["n0"], all_pairs["n1"]], 1.0)),
        (keys(held, "before")[order], both(held)[order]),
    )
    x, y = [], fits["toxic"].to_numpy().astype(float)
    for batch in fits.to_batches():
        for _, data, at in W.chunks(batch):
            x.append(model.differences(data, at)[0])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.slope, model.offset = fit_logistic(np.concatenate(x), y, weight)
    return model, share


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, score, predicted: one row per row of ``docs``."""
    model, share = train(docs, labels, sample)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if model is None:
        scored = narrow.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        sent = W.send(docs.sparkSession, model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = W.received(sent)
            for batch in batches:
                for rows, data, at in W.chunks(batch):
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(model.score(data, at))], ["doc_id", "score"])

        scored = narrow.mapInArrow(run, "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
