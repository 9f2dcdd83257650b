"""Connected components in DataFrame operations only.

Alternating stars: a large star ties the larger neighbours of every node to its
least neighbour, a small star its smaller ones.  Each step is written to the shared folder, which cuts
the lineage.  The least neighbours are written before they are joined, so that adaptive execution
can split the rows of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import quoted, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` holds (u, v) with u > v; so does the result."""
    ends = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).union(edges) if large else edges
    least = stored(ends.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    met = ends.join(least.hint("merge"), "u")
    if large:
        # Larger neighbours go to the least of the node and its neighbours.
        out = met.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return stored(out.distinct(), "components-edges")


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node with a link to another; the component is its least node.

    Null ends and links of a node to itself count for nothing; repeated links
    count once; no links give an empty table.
    """
    a, b = quoted(left), quoted(right)
    edges = stored(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components-edges")
    while not _settled(edges):
        edges = _star(_star(edges, large=True), large=False)
    # Every node but the least of its component has exactly one link, to the least.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one lower neighbour at most, and that one has none."""
    ends = edges.groupBy("u").agg(F.count("*").alias("below")).union(
        edges.select(F.col("v").alias("u")).distinct().withColumn("below", F.lit(1).cast("long")))
    return ends.groupBy("u").agg(F.sum("below").alias("n")).where("n > 1").isEmpty()
