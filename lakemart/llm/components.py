"""Connected components of a graph too large for one machine.

Alternating star contraction: every round points each node's neighbours to
its smallest neighbour (large star: the larger neighbours; small star: the
smaller ones and itself) until the edges are stars around the smallest node of
each component.  A round is aggregates (combined map-side) and equi-joins
(whose hot keys adaptive execution splits), so a hub with any number of edges
is never one task's group.  Every round is written to the shared folder.

Defined results: self-loops and repeated edges change nothing; NULL ends are
dropped; nodes without an edge do not appear; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import drop_staged, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v), v < u."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join below reads two shuffles and adaptive
        # execution can split a hub's.
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components")
        # Larger neighbours w of u: w now points to u's least.
        found = edges.select(F.col("u").alias("w"), F.col("v").alias("u")).join(least, "u").select(
            F.col("w").alias("u"), F.col("m").alias("v"))
    else:
        least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "components")
        found = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return found.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge."""
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "components")
    before = None
    while True:
        state = now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        middle = staged(_star(now, large=True), "components")
        after = staged(_star(middle, large=False), "components")
        drop_staged(now, middle)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
