"""Running totals per key: one output row per input row, in the order of the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from heronry.functions.numbers import beyond_units, exact_total, from_units, in_units, rest_total
from heronry.session import materialize

# What a row adds to the sum (whole units, and what lies beyond them) and to the count of its key, and
# whether it is a row of the caller (1) or the totals its key starts from (0).
_UNITS, _REST, _WEIGHT, _TURN = "__units", "__rest", "__weight", "__turn"
_ADDED = {_UNITS: "__running_units", _REST: "__running_rest", _WEIGHT: "running_count"}


def running_totals(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    scale: int = 2,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``running_sum`` and ``running_count`` up to and including each row of its key.

    ``order`` must be a total order within a key. All rows are range-partitioned by key and order, so
    a key with very many rows lies in several partitions. Each partition is summed on its own; the keys
    that go on from one partition into the next are at most as many as there are partitions, and their
    totals of earlier partitions are added. ``df`` is evaluated twice, once for the sample that gives the
    cut points and once for the rows; store an input that is dear or not repeatable.

    ``earlier`` holds totals to start from, as :func:`key_totals` gives them. They go through the
    same window as first rows of their keys, which saves a join.
    """
    steps = df.withColumns(
        {
            _UNITS: in_units(F.col(value), scale).cast("decimal(18,0)"),
            _REST: beyond_units(F.col(value), scale),
            _WEIGHT: F.col(value).isNotNull().cast("bigint"),
            _TURN: F.lit(1),
        }
    )
    if earlier is not None:
        start = earlier.select(
            key,
            F.col("total_units").alias(_UNITS),
            F.col("total_rest").alias(_REST),
            F.col("total_count").alias(_WEIGHT),
            F.lit(0).alias(_TURN),
        )
        steps = steps.unionByName(start, allowMissingColumns=True)
    summed = _summed(steps, key, [_TURN, *order]).where(F.col(_TURN) == 1)
    total = from_units(F.col(_ADDED[_UNITS]), scale, F.col(_ADDED[_REST]))
    return summed.select(*df.columns, total.alias("running_sum"), _ADDED[_WEIGHT])


def running_average(df: DataFrame, key: str, order: list[str], value: str, **options) -> DataFrame:
    """``df`` with the average of the key's values so far in ``running_avg``."""
    totals = running_totals(df, key, order, value, **options)
    return totals.withColumn(
        "running_avg", F.try_divide(F.col("running_sum"), F.col("running_count"))
    )


def key_totals(df: DataFrame, key: str, value: str, scale: int = 2) -> DataFrame:
    """Total and count of each key, in the form :func:`running_totals` can start from."""
    return df.groupBy(key).agg(
        exact_total(F.col(value), scale).alias("total_units"),
        rest_total(F.col(value), scale).alias("total_rest"),
        F.count(value).alias("total_count"),
    )


def add_key_totals(totals: DataFrame, key: str) -> DataFrame:
    """Add up totals of the same key."""
    return totals.groupBy(key).agg(
        *[
            F.sum(c).cast(totals.schema[c].dataType).alias(c)
            for c in ("total_units", "total_rest", "total_count")
        ]
    )


def _so_far(partition: list[str], order: list[str], last: int) -> WindowSpec:
    window = Window.partitionBy(*partition).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, last)


def _summed(steps: DataFrame, key: str, order: list[str]) -> DataFrame:
    # Stored, because the cut points come from a sample and must be the same for both uses below.
    cut = materialize(
        steps.repartitionByRange(key, *order).withColumn("__piece", F.spark_partition_id()),
        "running-pieces",
    )
    so_far = _so_far([key, "__piece"], order, Window.currentRow)
    local = cut.withColumns({name: F.sum(c).over(so_far) for c, name in _ADDED.items()})
    before = _so_far(["__key"], ["__of"], -1)
    pieces = F.count(F.lit(1)).over(Window.partitionBy("__key"))
    # Of the keys in more than one piece there are fewer than pieces, and no more rows than two a piece.
    carried = (
        cut.groupBy(F.col(key).alias("__key"), F.col("__piece").alias("__of"))
        .agg(*[F.sum(c).alias(c) for c in _ADDED])
        .withColumn("__pieces", pieces)
        .where(F.col("__pieces") > 1)
        .select("__key", "__of", *[F.sum(c).over(before).alias(f"{c}_before") for c in _ADDED])
    )
    same_piece = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__piece") == F.col("__of"))
    return local.join(F.broadcast(carried), same_piece, "left").select(
        *steps.columns,
        *[
            _plus(name, f"{c}_before").cast(local.schema[name].dataType).alias(name)
            for c, name in _ADDED.items()
        ],
    )


def _plus(part: str, carried: str) -> Column:
    """A running value plus what came before its piece; null only if both are."""
    before = F.col(carried)
    return F.coalesce(F.col(part) + F.coalesce(before, F.lit(0)), before)
