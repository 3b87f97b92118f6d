"""Connected components by alternating stars, in Spark joins and sums alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import stored

# Edges that a plan may broadcast if their files are small. Files do not tell: edges between
# a few thousand nodes take two or three bytes there, and tens in memory.
FEW_EDGES = 100_000


def _large_star(edges: DataFrame, many: bool) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    larger = both.filter("b > a")
    least = least.hint("merge") if many else least
    return larger.join(least, larger["a"] == least["k"]).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )


def _small_star(edges: DataFrame, many: bool) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    least = least.hint("merge") if many else least
    joined = edges.join(least, edges["a"] == least["k"])
    return joined.select(
        F.explode(
            F.array(
                F.struct(F.col("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )
        ).alias("e")
    ).select("e.a", "e.b")


def _proper(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller, no loops."""
    return (
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest node.

    ``edges`` has two comparable columns ``a`` and ``b``; loops and repeats do no
    harm, an empty table gives an empty result. Edges only ever move towards
    smaller nodes, so the rounds end, after about the logarithm of the longest
    path; each is written to the shared folder. A hub's edges are combined to one
    minimum per task before they are shuffled.
    """
    edges = stored(_proper(edges), "edges")
    before = None
    while True:
        signature = edges.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if signature == before or signature["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        before = signature
        many = signature["n"] > FEW_EDGES
        large = _large_star(edges, many).distinct()
        edges = stored(_proper(_small_star(large, many)), "edges")
