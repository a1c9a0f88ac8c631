"""Connected components by alternating star contraction, on tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import written


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``component`` is its smallest reachable node.

    ``edges`` has columns ``a`` and ``b`` of one ordered type. A round links each node's larger neighbours to its
    smallest one, then each node's smaller neighbours to the smallest of them. The number of rounds is logarithmic;
    what is shuffled never exceeds the edges, and a node of many edges is a minimum that combines before the shuffle
    and a join that AQE splits. Each round is written to the shared folder.
    """
    now = written(_directed(edges))
    before = _state(now)
    while before[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionAll(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct())
        after = _state(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
