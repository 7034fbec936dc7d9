"""Connected components of a graph given as an edge table, by alternating star contractions.

Each round writes its edges as a table: a lost executor repeats one round at most. A round hangs
every node's larger neighbours on its smallest one (large star), then its smaller ones (small
star); only minima by node are aggregated, so a hub is pre-aggregated by each task. The number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns, ends of links in any order, repeats allowed. Returns
    (node, root) for every node that is not its component's smallest (``root``)."""
    a, b = edges.columns
    links = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    links = materialize(links.distinct(), "links")
    before, now = None, _state(links)
    while now != before:
        links = materialize(_small_star(_large_star(links).distinct()).distinct(), "links")
        before, now = now, _state(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
