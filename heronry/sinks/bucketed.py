"""Keyed catalog tables stored in buckets, and merges that leave the stored side where it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from heronry.functions.numbers import exact_plus
from heronry.operators.aggregates import METRIC_SCALE
from heronry.operators.keyed import merge_unkeyed


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Replace a catalog table whose files are dealt out by the hash of ``key`` and sorted by it.

    Rows are dealt to one task a bucket first, so a table has as many files as buckets. Choose ``buckets`` for
    the size of the table, not of a batch.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def merged_metrics(
    stored: DataFrame,
    batch: DataFrame,
    key: str,
    counters: list[str],
    recency: list[str],
    newest_by: str,
    scale: int = METRIC_SCALE,
    keep_unknown: bool = False,
) -> DataFrame:
    """What :func:`heronry.operators.keyed.merge_additive` gives, for a table with one row a key that is bucketed
    by it: a full outer join that shuffles the batch only. ``batch`` must have one row a key as well. Rows without
    a key do not meet in a join and are added up beside it."""
    old, new = (df.where(F.col(key).isNotNull()).alias(name) for df, name in ((stored, "old"), (batch, "new")))
    rows = old.hint("merge").join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    def side(table: str) -> Column:
        return F.struct(F.col(f"{table}.{newest_by}").alias("__order"), *[F.col(f"{table}.{c}") for c in recency])

    # Of equal times the larger columns win, whichever side has them; a side without the key does not count.
    missing_old, missing_new = F.col(f"old.{key}").isNull(), F.col(f"new.{key}").isNull()
    winner = (
        F.when(missing_old, side("new")).when(missing_new, side("old")).otherwise(F.greatest(side("old"), side("new")))
    )

    def added(c: str) -> Column:
        a, b = F.col(f"old.{c}"), F.col(f"new.{c}")
        kind = stored.schema[c].dataType
        if isinstance(kind, T.DoubleType):
            total = exact_plus(a, b, scale)
        else:
            total = (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).cast(kind)
        return (F.when(a.isNotNull() | b.isNotNull(), total) if keep_unknown else total).alias(c)

    keyed = rows.select(
        F.coalesce(f"old.{key}", f"new.{key}").alias(key), *[added(c) for c in counters], winner.alias("__winner")
    ).select(key, *counters, *[F.col(f"__winner.{c}").alias(c) for c in recency])
    return keyed.unionByName(
        merge_unkeyed(stored, batch, key, counters, recency, newest_by, scale, keep_unknown)
    )


def merge_bucketed(
    spark: SparkSession,
    name: str,
    into: str,
    batch: DataFrame,
    key: str,
    counters: list[str],
    recency: list[str],
    newest_by: str,
    buckets: int,
    path: str | None = None,
    keep_unknown: bool = False,
) -> None:
    """Merge ``batch`` into the bucketed table ``name`` and save the result as ``into``, bucketed alike. The
    result of the join is dealt out by the key already, so it is written without another shuffle."""
    made = merged_metrics(spark.table(name), batch, key, counters, recency, newest_by, keep_unknown=keep_unknown)
    writer = made.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(into)
