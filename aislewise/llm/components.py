"""Connected components of an undirected graph, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of `edges` (a, b) reaches, as rows (node, component).

    Alternates large-star and small-star steps: every node hands its larger (then its
    smaller) neighbours to its smallest one, until nothing changes; the edges then are
    stars around the smallest nodes. Each round is stored, which cuts the lineage. A node with very many neighbours is
    aggregated before the shuffle and met again by a join, so no task gathers them.
    Self loops and repeated edges are harmless; a node without edges has no row.
    """
    edges = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stage(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Number and checksum of the edges; equal for equal sets, whatever their order."""
    checksum = F.expr("bit_xor(xxhash64(u, v))")
    return tuple(edges.agg(F.count("*"), checksum, F.max("u")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).where("u <> v").distinct()
