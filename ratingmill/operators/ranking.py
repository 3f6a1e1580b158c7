"""Row positions without a one-task window, and top-n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingmill.params import DEFAULTS
from ratingmill.session import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in 33 bits


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """1-based position of every row under a total order.

    Rows are range-partitioned by the order, numbered inside their partition and shifted by the
    sizes of the partitions before. Only the partition sizes pass one task. The sorted rows are
    written first, so that sizes and rows come from the same partitioning.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = stage(ordered.withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    numbered = written.select(
        *df.columns,
        F.shiftright("_mid", _ROW_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg((F.max("_row") + 1).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the sort: bounded by the number of shuffle partitions.
    return numbered.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row") + 1).alias(name)
    )


def with_group_rank(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    hot_rows: int = DEFAULTS.hot_group_rows,
    rank: str = "rank",
    count: str = "count",
    bound: DataFrame | None = None,
) -> DataFrame:
    """Rank inside a group by a total order, and the size of the group, on every row.

    Groups up to ``hot_rows`` rows use one window. A larger group would be one long task, so its
    rows are ranked by their position in a range-partitioned sort instead. ``bound`` may hold a
    table that has at least as many rows per group and is cheaper to count than ``df``.
    """
    sizes = (df if bound is None else bound).groupBy(group).agg(F.count("*").alias("_n"))
    hot = sizes.filter(F.col("_n") > hot_rows).select(group)
    window = Window.partitionBy(group)

    def by_window(rows: DataFrame) -> DataFrame:
        return rows.withColumn(rank, F.row_number().over(window.orderBy(*order)).cast("bigint")).withColumn(
            count, F.count("*").over(window)
        )

    if hot.isEmpty():
        return by_window(df)
    hot, df = stage(hot, "hot"), stage(df, "grouped")
    placed = with_position(df.join(hot, group, "left_semi"), [group, *order], "_pos")
    starts = placed.groupBy(group).agg(F.min("_pos").alias("_start"), F.count("*").alias(count))
    hot_ranked = placed.join(starts, group).select(
        *df.columns, (F.col("_pos") - F.col("_start") + 1).alias(rank), count
    )
    return by_window(df.join(hot, group, "left_anti")).unionByName(hot_ranked)


def top_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of every group with rank 1..n.

    The filter on row_number lets Spark cut every map task's share of a group to ``n`` rows
    before the shuffle, so a hot group costs n rows per task.
    """
    keys = [group] if isinstance(group, str) else list(group)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
