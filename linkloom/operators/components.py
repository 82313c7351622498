"""Connected components with the least member as label.

Alternating large-star and small-star rounds (Kiveris et al., 2014): each round is
a minimum per node (partial aggregate) and a join back, and the number of rounds
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where(F.col("v") > F.col("u")).join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def star_links(df: DataFrame, group: list[str], node: str) -> DataFrame:
    """Link the members of a group to its least member: n-1 edges instead of all pairs."""
    hubs = df.groupBy(*group).agg(F.min(node).alias("v"))
    return df.join(hubs, group).where(F.col(node) != F.col("v")).select(F.col(node).alias("u"), "v").distinct()


def connected_components(vertices: DataFrame, edges: DataFrame, node: str, src: str, dst: str, name: str = "component") -> DataFrame:
    """(node, component) for every vertex; the label is the least node of the component."""
    current = cut_lineage(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u") != F.col("v")).distinct()
    )
    mark = _fingerprint(current)
    while mark[0]:
        current = cut_lineage(_small_star(_large_star(current)))
        latest = _fingerprint(current)
        if latest == mark:
            break
        mark = latest
    labels = current.select(F.col("u").alias(node), F.col("v").alias("_label"))
    return (
        vertices.select(node).distinct().join(labels, node, "left")
        .select(node, F.coalesce("_label", node).alias(name))
    )
