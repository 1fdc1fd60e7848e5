"""Connected components of a table of links, as repeated joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronry.session import materialize


def _toward_smallest(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = links.select("a", "b").unionAll(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .distinct()
    )


def _under_smallest(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = (
        links.join(least, "a")
        .where(F.col("b") != F.col("least"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def component_roots(links: DataFrame) -> DataFrame:
    """(a, b) links → (node, root): the smallest node of each component, for all other nodes in it.

    The two steps alternate until the links no longer change, which takes a number of rounds that
    grows with the logarithm of the number of nodes. Every round is written to the shared folder,
    so a lost executor costs at most one round. Self-links and repeated links are allowed; a node
    that is linked to nothing else is not in the result; no links give no rows.
    """
    links = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links, before = materialize(_under_smallest(links), "links"), None
    while True:
        links = materialize(_under_smallest(_toward_smallest(links)), "links")
        state = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes"),
        ).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
