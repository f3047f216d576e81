"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import cut_lineage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node reachable.

    ``links`` has two columns of one orderable type; direction and repeats don't matter, and
    null ends and loops are left out.  Alternates the large-star and small-star steps until the
    links no longer change, which takes a number of rounds that grows with the logarithm of
    the longest path.  Each round is written to the shared folder; the driver sees a row count
    and a hash.
    """
    a, b = (F.col(c) for c in links.columns[:2])
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a.isNull() | b.isNull()).alias("gap"))
    now = cut_lineage(now.where("not gap and u <> v").select("u", "v").distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now = cut_lineage(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
