"""Connected components of links, in Spark, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import beside, stored


def _state(edges: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum."""
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    row = edges.agg(F.count(F.lit(1)).alias("n"), checksum.alias("c")).first()
    return row["n"], row["c"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of these. ``a`` is the larger end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _leaves(edges: DataFrame) -> DataFrame:
    """The edges (a, b) of nodes a that have no other edge, b being smaller."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("smaller"))
    ends = ends.unionAll(edges.select(F.col("b").alias("node"), F.lit(None).cast(edges.schema["a"].dataType).alias("smaller")))
    counted = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("smaller").alias("b"))
    return counted.where("n = 1 AND b IS NOT NULL").select(F.col("node").alias("a"), "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that a link (a, b) names; component is the least node.

    Links with a null end and links of a node to itself count for nothing; direction and repeats
    don't matter. Each round is written to the shared folder; nothing is collected but a row count
    and a checksum. A node with very many links is split like any skewed join and counted in parts.
    Nodes with a single link, to a smaller node, wait outside of the rounds for that node's component.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    given = stored(ends.distinct())
    leaves = stored(_leaves(given))
    inner = _inner_components(stored(given.join(beside(leaves.select("a")), "a", "left_anti")))
    inner = stored(inner)
    to = beside(inner.select(F.col("node").alias("b"), "component"))
    met = leaves.join(to, "b", "left").select(F.col("a").alias("node"), F.coalesce("component", "b").alias("component"))
    # A smaller node that only leaves name is its own component.
    alone = leaves.select("b").distinct().join(beside(inner.select(F.col("node").alias("b"))), "b", "left_anti")
    return inner.unionAll(met).unionAll(alone.select(F.col("b").alias("node"), F.col("b").alias("component")))


def _inner_components(edges: DataFrame) -> DataFrame:
    """(node, component) by large and small stars; every edge (a, b) is there once, with a > b."""
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if before == state:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
