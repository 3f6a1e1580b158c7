"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingmill.session import stage


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node that is reachable) for every node of the links (a, b).

    Each round links the larger neighbours of a node to the smallest one, then the smaller ones; a chain halves
    each round. Hot nodes are joined, never gathered. Every round is written, so lost executors cost one round.
    """
    links = stage(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo").distinct(), "links")
    before = None
    while True:
        both = links.unionAll(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.filter("hi > lo").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(F.explode(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        links = stage(small.select("e.*").filter("hi > lo").distinct(), "links")
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.groupBy("hi").agg(F.min("lo").alias("component")).withColumnRenamed("hi", "node").unionAll(roots)
