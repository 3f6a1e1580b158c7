"""Mixing sources to target weights with DataFrame operations only.

Every document gets a key that is random by hash and the same on each run. A source is cut into ranges of that key,
each range is sorted by itself, and word counts are summed over the ranges before, so a source with a third of all
rows is spread over as many tasks as it has ranges. A source is taken whole as often as its budget allows, then in key
order up to the exact remaining number of words; the document at the cut is taken in part.

Budgets: source k by code point (null last) has weight ``weights[k % len(weights)]``, and the budgets add up to the
words of all sources. A budget stops at ``cap`` times the source's words; the excess is shared by weight among the
others until none is above.

Defined cases: null or empty text has size 0 and is taken 0 times; a null source is a source of its own; rows that repeat
a doc_id are different rows with the same key; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingmill.session import stage

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
RANGE_ROWS = 8_000
_KEY_RANGE = 1 << 40


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("bigint").alias("size"))


def budgets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target: one row per source.

    With caps sorted by cap over weight, the capped sources are the first ones: a source is capped if its cap is at most
    what its weight gets of the words that the sources before leave.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source passes these windows, never a row per document.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("_w", weight).withColumn("_cap", (F.col("source_size") * cap).cast("double"))
    order = (F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    per = per.withColumn("_level", left / F.sum("_w").over(onward))
    capped = F.col("_cap") <= F.col("_level") * F.col("_w")
    # The level of the first source that is not capped holds for all that follow; theirs are lower.
    per = per.withColumn("_free", F.when(capped, F.lit(None)).otherwise(F.col("_level")))
    per = per.withColumn("_level", F.max("_free").over(everything))
    return per.select("source", "source_size", F.when(F.col("_free").isNull(), F.col("_cap")).otherwise(F.col("_level") * F.col("_w")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of ``docs``."""
    key = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 10), 16, 10).cast("bigint")
    sized = stage(sizes(docs).withColumn("_key", F.coalesce(key, F.lit(0))), "sizes")
    ranges = max(1, -(-sized.count() // range_rows))
    keyed = sized.withColumn("_range", F.floor(F.col("_key") * F.lit(ranges) / F.lit(float(_KEY_RANGE))).cast("int"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("source", "_range").agg(F.sum("size").alias("_sum")).select(
        F.col("source").alias("_source"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    budget = budgets(sized, weights, cap).withColumnRenamed("source", "_s")
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r")))
    placed = placed.join(budget, F.col("source").eqNullSafe(F.col("_s")))
    words = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = words - epochs * F.col("source_size") - F.col("_start") - F.col("_offset")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))
