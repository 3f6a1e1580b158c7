"""Joins of many rows with one row per key, where one key may hold a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000
HOT_KEYS = 1_000


def join_counted(rows: DataFrame, table: DataFrame, keys: Sequence[str], total: int, count: str = "n", how: str = "inner") -> DataFrame:
    """Join (``how``: inner or left) of ``rows`` with ``table``, which has one row per key and how many of the ``total`` rows have it (``count``).

    Keys of more than ``HOT_ROWS`` rows and more than a ``HOT_KEYS``-th of all are at most ``HOT_KEYS`` keys: those are broadcast, so
    their rows stay where they are. All other keys are shuffled, and none of them is a large part of a task's rows.
    """
    hot = F.col(count) > max(HOT_ROWS, total // HOT_KEYS)
    few = F.broadcast(table.filter(hot))
    cold = rows.join(F.broadcast(table.filter(hot).select(*keys)), list(keys), "left_anti")
    return rows.join(few, list(keys)).unionByName(cold.join(table.filter(~hot), list(keys), how))


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``join_counted`` for a staged ``rows`` whose keys are counted here."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return join_counted(rows, table.join(counts, list(keys)), keys, rows.count(), "_n").drop("_n")
