"""TF-IDF in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingmill.functions.stopwords import ENGLISH
from ratingmill.params import DEFAULTS
from ratingmill.session import stage

# Fixed value: runs of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"
_TASK_ROWS = 1_000_000  # term rows a task holds at most, unless one text has more


def words(text: Column, stop_words: Sequence[str] = ENGLISH) -> Column:
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*stop_words)) if stop_words else tokens


def pairs_of(single: Column) -> Column:
    """Pairs of neighbouring words of a word array."""
    later = F.slice(single, 2, F.greatest(F.size(single) - 1, F.lit(0)))
    pairs = F.zip_with(single, later, lambda a, b: F.concat(a, F.lit(" "), b))
    # zip_with pads the shorter array with null.
    return F.filter(pairs, lambda p: p.isNotNull())


def exploded_terms(docs: DataFrame, stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """Words, and pairs of neighbouring words after stop-word removal, one row per occurrence.

    The words are a column of their own first: used several times, they are computed once.
    """
    return _terms(_split(docs, stop_words))


def _split(docs: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    return docs.select("id", words(F.col("text"), stop_words).alias("_words"))


def _terms(split: DataFrame) -> DataFrame:
    return split.select("id", F.explode(F.concat("_words", pairs_of(F.col("_words")))).alias("term"))


def vocabulary(term_rows: DataFrame, max_terms: int = DEFAULTS.max_terms) -> DataFrame:
    """Most frequent terms over all texts, ties alphabetical. Counts are combined map-side."""
    return (
        term_rows.groupBy("term")
        .agg(F.count("*").alias("frequency"))
        .orderBy(F.desc("frequency"), "term")
        .limit(max_terms)
    )


def tfidf(
    docs: DataFrame,
    max_terms: int = DEFAULTS.max_terms,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """Length-one TF-IDF rows ``(id, term, weight)`` of the texts ``(id, text)``.

    The texts are taken apart once, their words written and read twice: for the vocabulary, where only counts per term are
    shuffled, and for the counts per text of vocabulary terms. Words travel once to the task of their text, where its terms
    are counted and weighed, and the number of these tasks grows with the words, so none holds more in a larger corpus.
    """
    split = stage(_split(docs, stop_words), "words")
    texts, total = split.agg(F.count("*"), F.coalesce(F.sum(2 * F.size("_words")), F.lit(0))).first()
    # At most max_terms rows.
    kept = F.broadcast(stage(vocabulary(_terms(split), max_terms).select("term"), "vocabulary"))
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // _TASK_ROWS))
    by_text = _terms(split.repartition(tasks, "id")).join(kept, "term")
    counts = stage(by_text.groupBy("id", "term").agg(F.count("*").alias("tf")), "term_counts")
    # At most max_terms rows.
    df = F.broadcast(counts.groupBy("term").agg(F.count("*").alias("df")))
    idf = F.log((1.0 + texts) / (1.0 + F.col("df"))) + 1.0
    raw = counts.repartition(tasks, "id").join(df, "term").select("id", "term", (F.col("tf") * idf).alias("raw"))
    # A text holds at most max_terms vocabulary terms.
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))
    return raw.select("id", "term", (F.col("raw") / norm).alias("weight"))
