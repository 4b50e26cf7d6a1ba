"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlens.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge (a, b); root is the smallest node reachable.

    Each round links the neighbours of a node to the smallest of them, first the larger
    ones, then the smaller ones; rounds grow with the logarithm of the component size.
    Every round is written to the shared folder; one number a round reaches the driver.
    The least neighbours are written too: Spark splits the rows of a node with very many
    neighbours only in a join of two tables that it deals for that join.
    """
    known = edges.where("a <> b")
    links = stage(
        known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "least")
        larger = (
            both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        larger = stage(larger, "larger")
        low = stage(larger.groupBy("a").agg(F.min("b").alias("low")), "least")
        smaller = larger.join(low, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                )
            ).alias("edge")
        ).select("edge.*").where("a <> b").distinct()
        links = stage(smaller, "links")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
