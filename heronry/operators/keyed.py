"""Keyed tables: merges, change batches, updates. Each function gives the new content of the table;
:mod:`heronry.sinks.versions` stores it as the next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from heronry.functions.numbers import exact_sum
from heronry.operators.aggregates import METRIC_SCALE
from heronry.operators.ranking import latest_per_key


def merge_additive(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    counters: list[str],
    recency: list[str],
    newest_by: str,
    keep_newest: bool = True,
    scale: int = METRIC_SCALE,
    keep_unknown: bool = False,
) -> DataFrame:
    """Add a batch of metrics to a keyed table.

    Keys in both: counters are added (an unknown counter counts as 0; doubles as by
    :func:`heronry.functions.numbers.exact_sum`) and recency columns replaced. Keys only in the batch are
    inserted. With ``keep_unknown`` a counter that neither side knows stays unknown, as the sum over all
    rows behind both sides would be; without it, it is 0. With ``keep_newest`` the recency columns of the side with the later ``newest_by`` win, so a
    late batch does not set the clock back; of equal ones, the side with the larger recency columns, so
    the order of the arguments does not matter. Without it the batch always wins. All recency columns of
    a key come from one side.

    A union and one aggregation do it in one shuffle, and partial sums absorb hot keys.
    """
    both, measures = _measures(table, batch, key, counters, recency, newest_by, keep_newest, scale, keep_unknown)
    return _flat(both.groupBy(key).agg(*measures), key, counters, recency)


def merge_unkeyed(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    counters: list[str],
    recency: list[str],
    newest_by: str,
    scale: int = METRIC_SCALE,
    keep_unknown: bool = False,
) -> DataFrame:
    """The row that :func:`merge_additive` gives for the rows without a key, none where there are none. It needs
    no shuffle by key."""
    unkeyed = [df.where(F.col(key).isNull()) for df in (table, batch)]
    both, measures = _measures(*unkeyed, key, counters, recency, newest_by, True, scale, keep_unknown)
    found = both.agg(F.max(key).alias(key), *measures, F.count("*").alias("__rows")).where("__rows > 0")
    return _flat(found, key, counters, recency)


def _measures(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    counters: list[str],
    recency: list[str],
    newest_by: str,
    keep_newest: bool,
    scale: int,
    keep_unknown: bool,
) -> tuple[DataFrame, list[Column]]:
    columns = [key, *counters, *recency]
    both = table.select(*columns, F.lit(0).alias("__batch")).unionByName(
        batch.select(*columns, F.lit(1).alias("__batch"))
    )
    order = F.col(newest_by) if keep_newest else F.col("__batch")
    # Null sorts below every time.
    winner = F.max(F.struct(order.alias("__order"), *[F.col(c) for c in recency])).alias("__winner")

    def added(c: str) -> Column:
        kind = table.schema[c].dataType
        total = exact_sum(F.col(c), scale) if isinstance(kind, T.DoubleType) else F.sum(c)
        return (total if keep_unknown else F.coalesce(total, F.lit(0))).cast(kind).alias(c)

    return both, [*[added(c) for c in counters], winner]


def _flat(merged: DataFrame, key: str, counters: list[str], recency: list[str]) -> DataFrame:
    return merged.select(key, *counters, *[F.col(f"__winner.{c}").alias(c) for c in recency])


def apply_changes(
    table: DataFrame, changes: DataFrame, key: str, sequence: list[str], action: str = "action"
) -> DataFrame:
    """Apply inserts, updates and deletes by key; of several changes to a key the last one counts.

    Inserts and updates carry the whole row. Finding the last change keeps one row per key and task
    before the shuffle, so a key with very many changes is no bottleneck. Rows of the table without a key
    match no change and stay; they do not go through the join, where they would meet in one task.
    """
    last = latest_per_key(changes, [key], *sequence).select(
        F.col(key).alias("__key"),
        F.col(action).alias("__action"),
        *[F.col(c).alias(f"__{c}") for c in table.columns if c != key],
    )
    changed = F.col("__action").isNotNull()
    keyed = table.where(F.col(key).isNotNull())
    rows = keyed.join(last, F.col(key) == F.col("__key"), "full_outer")
    changed_rows = rows.where(~changed | (F.col("__action") != "delete")).select(
        *[
            F.when(changed, F.col("__key" if c == key else f"__{c}")).otherwise(F.col(c)).alias(c)
            for c in table.columns
        ]
    )
    return changed_rows.unionByName(table.where(F.col(key).isNull()))


def update_where(df: DataFrame, column: str, value: Column, condition: Column) -> DataFrame:
    """Set a column where a condition holds, keeping its type."""
    changed = F.when(condition, value).otherwise(F.col(column))
    return df.withColumn(column, changed.cast(df.schema[column].dataType))


def drop_column(df: DataFrame, column: str) -> DataFrame:
    """Drop a column; the next version of the table has its own, narrower schema."""
    return df.drop(column)
