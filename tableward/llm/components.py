"""Connected components of a graph of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableward.session import stage


def _downward(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, each once, loops left out."""
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of each node on the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))


def _mark(edges: DataFrame) -> tuple:
    got = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return got[0], got[1]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that an edge ``u, v`` touches; the root is the smallest node.

    Each round at least halves the depth, so rounds grow with the logarithm of the longest
    chain.  Every round is a written table; only a count and a checksum reach the driver.
    """
    now = stage(_downward(edges.select("u", "v")), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stage(_downward(_small_star(_downward(_large_star(now)))), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
