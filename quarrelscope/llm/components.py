"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is one aggregation and one join over the links; steps read and write
tables in the shared folder, so a lost executor costs no more than one step.  The
links never meet in one task: a hub's links are partially aggregated before the
shuffle, and it gets its least neighbour by a bounded broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(links: DataFrame, large: bool, total: int) -> DataFrame:
    """links (a > b): one large-star or small-star step, giving links (a > b) again; total: about how many there are."""
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", "n", F.least("u", "m").alias("m"))
    joined = common.joined(near, lowest, "u", "n", total)
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node it reaches.

    links: columns a and b of one orderable type, in any direction, repeated or not;
    links of a node to itself give nothing.
    """
    links = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = common.written(links, "links")
    before = _sum(links)
    while before[0]:  # each step brings the nodes of a component nearer to its least; a logarithmic number of steps
        links = common.written(_star(common.written(_star(links, True, 2 * before[0]), "links"), False, before[0]), "links")
        now = _sum(links)
        if now == before:
            break
        before = now
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
