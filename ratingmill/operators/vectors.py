"""Packed sparse vectors: one row per id instead of one per id and feature.

``packed`` turns a long table into sorted index and weight arrays. Weighted means and products of listed pairs then shuffle one row per
rating or pair, and the features are handled inside the row by built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1_000


def packed(rows: DataFrame) -> DataFrame:
    """``(id, entries)``: the (feature, weight) structs of a long table by feature. For vectors of a bounded number of features."""
    return rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("feature", "weight"))).alias("entries"))


def unpacked(vectors: DataFrame) -> DataFrame:
    return vectors.select("id", F.inline("entries"))


def slim(vectors: DataFrame) -> DataFrame:
    """``(id, feature, weight)``: packed vectors as two flat arrays, half the bytes of the structs in a shuffle."""
    return vectors.select("id", F.col("entries.feature").alias("feature"), F.col("entries.weight").alias("weight"))


def packed_units(rows: DataFrame) -> DataFrame:
    """As ``packed``, every vector divided by its length; a zero vector stays zero."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm")
    # The length comes out of the grouping: as a column of its own it would be formed again for every entry.
    vectors = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("feature", "weight"))).alias("entries"), norm)
    unit = F.transform(
        "entries",
        lambda e: F.struct(e["feature"].alias("feature"), F.coalesce(F.try_divide(e["weight"], F.col("_norm")), F.lit(0.0)).alias("weight")),
    )
    return vectors.select("id", unit.alias("entries"))


def dense(entries: Column, width: int) -> Column:
    """An array of ``width`` weights from entries with features 1 to ``width``, zeros between them."""

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0), n.cast("int"))

    # The feature before each entry, formed once: a look-up inside the transform would copy the array for every entry.
    features = entries["feature"]
    before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(features, 1, F.greatest(F.size(features) - 1, F.lit(0))))
    filled = F.zip_with(entries, before, lambda e, p: F.when(e.isNotNull(), F.concat(zeros(e["feature"] - p - 1), F.array(e["weight"]))))
    tail = zeros(F.lit(width) - F.coalesce(F.try_element_at(features, F.lit(-1)), F.lit(0)))
    return F.concat(F.flatten(F.array_compact(filled)), tail)


def weighted_sums(ratings: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rating-weighted sum of the vectors an owner rated: long rows (owner, feature, weight).

    ``ratings`` is (owner, id, rating), ``vectors`` is packed. A rating travels once, with its whole vector, to the task of its owner, and is
    taken apart and summed there. Owners with more than a ``HOT_SHARE``-th of all ratings, ``HOT_SHARE`` of them at most, are summed
    where their ratings lie before their sums, one per feature and task, are shuffled. Without such owners the sums are left
    partitioned by owner, so grouping them by owner needs no shuffle.
    """
    rated = ratings.join(slim(vectors), "id")
    sizes = ratings.groupBy("owner").agg(F.count("*").alias("_n"))
    total, most = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    bound = max(1_000_000, total // HOT_SHARE)

    def summed(rows: DataFrame) -> DataFrame:
        terms = rows.select("owner", "rating", F.inline(F.arrays_zip("feature", "weight")))
        return terms.groupBy("owner", "feature").agg(F.sum(F.col("rating") * F.col("weight")).alias("weight"))

    if most <= bound:
        return summed(rated.repartition("owner"))
    hot = F.broadcast(sizes.filter(F.col("_n") > bound).select("owner"))
    cold = summed(rated.join(hot, "owner", "left_anti").repartition("owner"))
    return cold.unionByName(summed(rated.join(hot, "owner", "left_semi")))


def weighted_means(ratings: DataFrame, vectors: DataFrame) -> DataFrame:
    """``weighted_sums`` over the owner's total rating of the ids that have a vector."""
    known = ratings.join(vectors.select("id"), "id", "left_semi")
    totals = known.groupBy("owner").agg(F.sum("rating").alias("_total"))
    sums = weighted_sums(ratings, vectors).join(totals, "owner")
    return sums.select("owner", "feature", (F.col("weight") / F.col("_total")).alias("weight"))


def pair_products(pairs: DataFrame, left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    """``pairs`` (id, key) with ``product``, the dot product of packed left id and right key; null where one of them is unknown.

    A pair takes the entries of its right vector along to its left vector, which is laid out densely once per id: a product is one pass
    over the right entries with a look-up each.
    """
    laid = left.select("id", dense(F.col("entries"), width).alias("_dense"))
    flat = slim(right).withColumnsRenamed({"id": "key", "feature": "_feature", "weight": "_weight"})
    rows = pairs.join(flat, "key", "left").join(laid, "id", "left")
    terms = F.zip_with("_feature", "_weight", lambda f, w: w * F.get(F.col("_dense"), f.cast("int") - 1))
    product = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("product", F.when(F.col("_dense").isNotNull(), product)).drop("_feature", "_weight", "_dense")
