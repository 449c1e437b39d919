"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, spread_join


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hangs its (larger, or smaller and own) neighbours on its smallest neighbour."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    pairs = edges.unionByName(turned) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = spread_join(pairs, least, "a", ["b"])  # a hub has as many neighbours as its component has nodes
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b): root is the smallest node that it reaches.

    Nodes must be comparable and not null; edges may repeat, run both ways or be loops. Each round is written to the
    shared folder, so a lost executor costs that round only; the number of rounds is logarithmic in the longest path.
    No edges: no rows.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct())
    before = _signature(now)
    while before[0]:
        now = materialize(_star(_star(now, True), False))
        after = _signature(now)
        if after == before:
            break
        before = after
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
