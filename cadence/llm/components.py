"""Connected components over an edge table, by alternating large-star and
small-star steps (Kiveris et al., 2014).  Every step is one grouped minimum
and one join; nothing is collected and no neighbourhood list is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (src, dst), src > dst, distinct.  Large star: every larger
    neighbour of u is hung under the smallest of u's neighbourhood; small
    star: u and its smaller neighbours are."""
    if large:
        hub = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
            edges.select(F.col("dst").alias("u"), F.col("src").alias("v"))
        )
        low = hub.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = hub.where("v > u").join(low, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    else:
        low = edges.groupBy("src").agg(F.min("dst").alias("m"))
        kids = edges.join(low, "src")
        out = kids.select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionByName(
            low.select("src", F.col("m").alias("dst"))
        )
    return out.where("src > dst").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; component is the
    smallest node reachable.  Edges: two columns a, b of longs, any order,
    loops and repeats allowed; nulls are ignored.  Raises if the star steps
    have not settled after ``max_rounds`` (the bound is logarithmic)."""
    e = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).distinct(), "cc"
    )
    for _ in range(max_rounds):
        # settled when every node hangs under exactly one root and no root hangs
        roots = e.select(F.col("dst").alias("src")).distinct()
        many = e.groupBy("src").count().where("count > 1").limit(1).count()
        if not many and not e.join(roots, "src", "left_semi").limit(1).count():
            return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
        e = staged(_star(_star(e, True), False), "cc")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
