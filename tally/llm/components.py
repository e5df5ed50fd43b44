"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(
        F.least(F.min("low"), F.first("high")).alias("least")
    )
    return (
        both.join(least, both["high"] == least["node"])
        .filter(F.col("low") > F.col("high"))
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    joined = edges.join(least, edges["high"] == least["node"])
    moved = joined.filter(F.col("low") != F.col("least")).select(
        F.col("low").alias("high"), F.col("least").alias("low")
    )
    own = least.select(F.col("node").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(own).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """The smallest node that each linked node can reach: (node, component).

    Only nodes with a link to another node come back; loops and nulls are left out. Smallest
    neighbours combine within tasks before each shuffle, so a node with a third of all links
    costs one row a task there; the join that follows is one that skew handling can split.
    Every round is written to the checkpoint folder. Rounds grow with the logarithm of the
    longest path.
    """
    links = (
        edges.select(
            F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
        )
        .filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("high") != F.col("low")))
        .distinct()
    )
    links = cut(links)
    before = None
    while True:
        mark = links.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
        if mark == before or not mark[0]:
            break
        before = mark
        links = cut(_small_star(_large_star(links)))
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
