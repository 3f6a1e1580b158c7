"""Principal components of a sparse long table by a randomised range finder.

The table (id, feature, weight) is only ever multiplied with a few columns from either side: a product with its ids or its features is a
join and a grouped sum of ``width`` numbers. Centring is a correction by the column means, so the table stays sparse. What reaches the
driver are matrices of ``width`` by ``width``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.session import stage

_TINY = 1e-12


def _names(width: int) -> list[str]:
    return [f"c{j}" for j in range(width)]


def _times(rows: DataFrame, key: str, other: str, factor: DataFrame, width: int) -> DataFrame:
    """Sums over ``other`` of weight times the columns of ``factor``, per ``key``."""
    sums = [F.sum(F.col("weight") * F.col(c)).alias(c) for c in _names(width)]
    return rows.join(factor, other).groupBy(key).agg(*sums)


def _gram(df: DataFrame, width: int) -> np.ndarray:
    """Inner products of the columns: one row of sums."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    found = df.agg(*[F.coalesce(F.sum(F.col(f"c{i}") * F.col(f"c{j}")), F.lit(0.0)) for i, j in pairs]).first()
    gram = np.zeros((width, width))
    for (i, j), value in zip(pairs, found):
        gram[i, j] = gram[j, i] = value
    return gram


def _turned(df: DataFrame, key: str, by: np.ndarray) -> DataFrame:
    """The columns times a small matrix."""

    def mixed(column: np.ndarray) -> Column:
        return sum((F.col(f"c{i}") * float(x) for i, x in enumerate(column)), F.lit(0.0))

    return df.select(key, *[mixed(by[:, j]).alias(f"c{j}") for j in range(by.shape[1])])


def _orthonormal(df: DataFrame, key: str, width: int) -> DataFrame:
    values, vectors = np.linalg.eigh(_gram(df, width))
    scale = np.where(values > _TINY * max(values.max(), _TINY), 1.0 / np.sqrt(np.maximum(values, _TINY)), 0.0)
    return stage(_turned(df, key, vectors * scale), "basis")


def sparse_components(rows: DataFrame, k: int = 2, extra: int = 6, passes: int = 4, seed: int = 42) -> tuple[DataFrame, list[float]]:
    """Every id on the first ``k`` components of its centred features, (id, component_1, ..), and their shares of the variance.

    ``rows`` is staged by the caller. Signs are arbitrary. ``extra`` columns and ``passes`` more rounds sharpen the estimate.
    """
    width = k + extra
    n = rows.select("id").distinct().count()
    means = stage(rows.groupBy("feature").agg((F.sum("weight") / F.lit(max(n, 1))).alias("mean"), F.sum(F.col("weight") ** 2).alias("squares")), "means")
    total = means.agg(F.coalesce(F.sum(F.col("squares") - F.col("mean") ** 2 * F.lit(n)), F.lit(0.0))).first()[0]

    def by_id(factor: DataFrame) -> DataFrame:
        shift = means.join(factor, "feature").agg(*[F.coalesce(F.sum(F.col("mean") * F.col(c)), F.lit(0.0)) for c in _names(width)]).first()
        product = _times(rows, "id", "feature", factor, width)
        return stage(product.select("id", *[(F.col(c) - F.lit(float(x))).alias(c) for c, x in zip(_names(width), shift)]), "by_id")

    def by_feature(basis: DataFrame) -> DataFrame:
        sums = basis.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in _names(width)]).first()
        product = _times(rows, "feature", "id", basis, width).join(means.select("feature", "mean"), "feature")
        centred = [(F.col(c) - F.col("mean") * F.lit(float(x))).alias(c) for c, x in zip(_names(width), sums)]
        return stage(product.select("feature", *centred), "by_feature")

    # Start columns from hashes: the same under any partitioning.
    start = [((F.pmod(F.xxhash64(F.lit(seed + j), "feature"), F.lit(20_001)) - 10_000) / 10_000.0).alias(f"c{j}") for j in range(width)]
    basis = _orthonormal(by_id(means.select("feature", *start)), "id", width)
    for _ in range(passes):
        basis = _orthonormal(by_id(by_feature(basis)), "id", width)
    values, vectors = np.linalg.eigh(_gram(by_feature(basis), width))
    order = np.argsort(-values)[:k]
    values = np.maximum(values[order], 0.0)
    scores = _turned(basis, "id", vectors[:, order] * np.sqrt(values))
    named = scores.select("id", *[F.col(f"c{j}").alias(f"component_{j + 1}") for j in range(k)])
    return named, [float(v / total) if total > 0 else 0.0 for v in values]
