"""Connected components of an undirected graph of long ids, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import discard, materialize


def _to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Connect neighbours to the least id seen from each node: all its larger neighbours
    (``larger_only``), or itself and its smaller ones. The least is found by an aggregate and
    joined back, so a node with many neighbours is not gathered."""
    if larger_only:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("least"))
        out = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("least"))
        out = down.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.select(F.col("n").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least id reachable over ``edges`` (a, b), for every node that has
    an edge to another one. Alternates the two steps above until nothing changes; every
    round is written to the shared folder, where it replaces the one before."""
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    seen = None
    while True:
        before, edges = edges, materialize(_to_least(_to_least(edges, True), False), "edges")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = now
