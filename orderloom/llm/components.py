"""Connected components of a graph kept as tables: alternating stars, each round one step on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of an edge between different nodes.

    Any ordered type does for nodes. Each round points a node's larger neighbours, then its smaller ones, at the smallest
    of them; the rounds needed grow with the square of the logarithm of the component size. Nothing is collected.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = cut_lineage(edges.where(F.col(a) != F.col(b)).select(high, low).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        stars = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        stars = cut_lineage(stars, "edges")
        least = stars.groupBy("u").agg(F.min("v").alias("m"))
        down = stars.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut_lineage(down.union(least.select("u", "m")).distinct(), "edges")
