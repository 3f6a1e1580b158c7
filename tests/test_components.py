"""Components of a sparse table against numpy, sketches against exact counts."""

import numpy as np
from pyspark.sql import functions as F

from ratingmill.operators import sketches
from ratingmill.operators.components import sparse_components


def _rows(spark, matrix):
    cells = [(int(i), int(f), float(matrix[i, f])) for i, f in zip(*np.nonzero(matrix))]
    return spark.createDataFrame(cells, "id bigint, feature bigint, weight double")


def test_components_explain_what_numpy_finds(spark):
    rng = np.random.default_rng(12)
    matrix = np.where(rng.random((120, 30)) < 0.2, rng.random((120, 30)), 0)
    matrix[:60, 3] += 2.0
    matrix[::3, 7] += 1.2
    matrix[:, 0] = 1.0  # a feature of every id does not vary
    centred = matrix - matrix.mean(0)
    values = np.linalg.svd(centred, compute_uv=False) ** 2
    rows, shares = sparse_components(_rows(spark, matrix))
    assert np.allclose(shares, values[:2] / values.sum(), atol=1e-6)
    got = np.array([[r["component_1"], r["component_2"]] for r in rows.orderBy("id").collect()])
    left, sizes, _ = np.linalg.svd(centred, full_matrices=False)
    want = left[:, :2] * sizes[:2]
    assert got.shape == (120, 2)
    assert all(np.allclose(got[:, j] * np.sign(got[:, j] @ want[:, j]), want[:, j], atol=1e-3) for j in (0, 1))


def test_components_without_rows_or_variance(spark):
    none, shares = sparse_components(_rows(spark, np.zeros((3, 3))))
    assert none.collect() == [] and shares == [0.0, 0.0]
    flat, shares = sparse_components(_rows(spark, np.ones((4, 2))))
    assert flat.count() == 4 and max(abs(x) for x in shares) < 1e-9


def test_sketches_of_days_answer_ranges(spark):
    rows = [(u, u % 50, d * 86_400 + 5) for d in range(4) for u in range(d * 100, d * 100 + 300)]
    ratings = spark.createDataFrame(rows, "userId bigint, movieId bigint, timestamp bigint")
    daily = sketches.daily_sketches(ratings)
    got = sketches.distinct_in(daily.filter("day < '1970-01-03'"), F.lit("first")).first()
    assert abs(got["users"] - 400) <= 12 and abs(got["movies"] - 50) <= 1
