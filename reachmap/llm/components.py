"""Connected components of an edge table, as repeated joins and aggregations.

Alternates two steps until nothing changes: every vertex links its larger
neighbours to its least neighbour, then its smaller neighbours and itself to the
least of them. Both keep the components; what is left in the end is a star
around the least vertex of each. The rounds grow with the logarithm of the
longest chain. Every round is written to the shared folder, and what tells whether
it changed anything is observed while it is written. The least neighbours are
written too before they meet the edges: a join of two read tables can split the rows of
a vertex that has very many, a join with an aggregate of the same rows can't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..storage import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _round(edges: DataFrame, label: str) -> tuple[DataFrame, dict]:
    """``edges`` (u, v) written, and a digest of them."""
    seen = Observation()
    return written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("digest")), label), seen.get


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every vertex that has an edge to another one; component: the least id reachable.

    Edges with a null end and loops are ignored; repeated ones don't matter.
    """
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    now, state = _round(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while state["n"]:
        # the large stars are read twice by the next step
        now, after = _round(_small_star(written(_large_star(now).distinct(), "large-stars")), "stars")
        if after == state:
            break
        state = after
    ends = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("id"), "component").distinct())


def named_by_least(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """``nodes`` (id, least, ..) with component_id: the least ``least`` of the nodes of a part (id, component), null counting as none."""
    held = written(parts.join(nodes, "id"), "held")
    # written, so that the rows of a large component can be dealt out in the join
    least = written(held.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    linked = held.join(least, "component").drop("component")
    return linked.unionByName(nodes.join(parts, "id", "left_anti").withColumn("component_id", F.col("least")))
