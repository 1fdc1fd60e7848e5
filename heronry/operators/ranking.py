"""Sorting, top-k and top-n per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def descending(df: DataFrame, measure: str, *tie_breakers: str) -> DataFrame:
    """Largest first; the tie breakers make the order total."""
    return df.orderBy(F.desc(measure), *tie_breakers)


def top(df: DataFrame, n: int, measure: str, *tie_breakers: str) -> DataFrame:
    """The ``n`` largest rows. Each task keeps its own ``n`` and only those are merged."""
    return descending(df, measure, *tie_breakers).limit(n)


def bottom(df: DataFrame, n: int, measure: str, *tie_breakers: str) -> DataFrame:
    """The ``n`` smallest rows."""
    return df.orderBy(F.asc(measure), *tie_breakers).limit(n)


def top_per_group(
    df: DataFrame, group: str, n: int, measure: str, *tie_breakers: str, rank: str = "rank"
) -> DataFrame:
    """The ``n`` largest rows of each group with their rank.

    Comparing ``row_number`` with a constant lets Spark keep ``n`` rows per group before the
    shuffle, so few or lopsided groups are no bottleneck.
    """
    order = Window.partitionBy(group).orderBy(F.desc(measure), *tie_breakers)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key in the given order."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")
