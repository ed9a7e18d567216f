"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchvoice.llm.stages import stage


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    pairs = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return pairs.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Node `id` and `component` (its smallest reachable id) of every node that has an edge (a, b).

    Self-loops and repeated edges do no harm. Every round is written to the shared folder; the
    driver sees a count and a checksum. A node with many neighbours is only aggregated (combined
    before the shuffle) and joined, and the join's large side can be split.
    """
    now = stage(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = _sum(now)
    while seen[0]:
        now = stage(_small(_large(now)), "edges")
        if (after := _sum(now)) == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
