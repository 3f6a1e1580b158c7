"""Registered queries against their SQL on the smallest tables.

Four run with RUN_SLOW=1 only, or all of them with ``python -m ratingmill.plans.check sf0.01``.
"""

import os

import duckdb
import pytest

from ratingmill.plans import all_queries
from ratingmill.plans.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
# Many full-size factor fits each.
SLOW = {"factor_grid_search", "boosted_hybrid_recs", "accuracy_with_factors", "paired_t_test_p_value"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    if name in SLOW and not os.environ.get("RUN_SLOW"):
        pytest.skip("slow; set RUN_SLOW=1")
    q = all_queries()[name]
    df = q.run(spark, FOLDER)
    got = df.collect()
    if q.sql is None:
        assert got
        return
    cursor = duck.execute(q.sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, cursor.fetchall())
