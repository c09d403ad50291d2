"""Connected components by alternating star operations (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.lineage import cut_lineage
from .skew import HOT_ROWS, join_facts


def _star(pairs: DataFrame, hot_rows: int) -> DataFrame:
    """Link all ``other`` of a node to the smallest node among them and itself.

    ``pairs`` holds (node, other). The smallest neighbour is an aggregation, handed back
    to the pairs by a join that splits nodes with very many neighbours.
    """
    lowest = pairs.groupBy("node").agg(F.min("other").alias("_low"), F.count(F.lit(1)).alias("_degree"))
    joined = join_facts(pairs, lowest, "node", "_degree", F.col("other"), hot_rows)
    return joined.withColumn("_low", F.least("node", "_low"))


def _large_star(edges: DataFrame, hot_rows: int) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("other")).union(
        edges.select(F.col("dst").alias("node"), F.col("src").alias("other"))
    )
    moved = _star(both, hot_rows).filter(F.col("other") > F.col("node"))
    return moved.select(F.col("other").alias("src"), F.col("_low").alias("dst")).distinct()


def _small_star(edges: DataFrame, hot_rows: int) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    down = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"))
    starred = _star(down, hot_rows)
    rest = starred.select(F.col("other").alias("src"), F.col("_low").alias("dst"))
    own = starred.select(F.col("node").alias("src"), F.col("_low").alias("dst"))
    return rest.union(own).filter(F.col("src") != F.col("dst")).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node either points at one other node or is
    pointed at. Each component is then one star around its smallest node."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("points")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("points")),
    )).alias("end")).select("end.*")
    roles = ends.groupBy("node").agg(F.sum("points").alias("out"), F.count_if(F.col("points") == 0).alias("in"))
    return roles.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))).isEmpty()


def connected_components(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, cluster) for every node of ``edges`` (src > dst, no edge twice); the
    cluster is its smallest node.

    Every step keeps the components and is written to the shared folder, so the plan
    stays short and a lost executor costs no earlier step. The rounds end when only
    stars are left.
    """
    current = cut_lineage(edges, "edges")
    while not _is_settled(current):
        current = cut_lineage(_large_star(current, hot_rows), "large-star")
        current = cut_lineage(_small_star(current, hot_rows), "small-star")
    members = current.select(F.col("src").alias("node"), F.col("dst").alias("cluster"))
    roots = current.select(F.col("dst").alias("node"), F.col("dst").alias("cluster")).distinct()
    return members.union(roots)
