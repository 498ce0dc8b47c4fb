"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import remove_staged, staged, staged_so_far

MOST_ROUNDS = 100


def _mark(edges: DataFrame) -> tuple:
    """Tells edge sets apart: rows, and two sums over their hashes."""
    hashed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(hashed), F.sum(F.hash("u", "v").cast("long"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for every node of ``links`` (a, b).

    Each round joins nodes to the smallest neighbour they know, which halves paths, and is staged
    in the shared folder. Minima are combined before they are shuffled and joined back to the
    links, so a node with many links is a skewed join, never a collected group. Nodes are of any
    ordered type; null ends, loops and repeated links don't count.
    """
    spark, mark_of_staged = links.sparkSession, staged_so_far()
    clean = links.where(F.col("a") != F.col("b"))
    edges = staged(
        clean.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    mark = _mark(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").where("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        edges = staged(
            small.unionByName(below.withColumnRenamed("m", "v")).distinct(), "links"
        )
        remove_staged(spark, mark_of_staged, edges)
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
    raise RuntimeError("components did not settle")
