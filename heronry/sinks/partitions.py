"""Partitioned datasets of which only the partitions that change are written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from heronry.operators.keyed import apply_changes, update_where
from heronry.session import materialize


def overwrite_partitions(df: DataFrame, path: str, partition: str, cluster: str) -> None:
    """Replace the partitions that ``df`` has rows for; all others keep their files.

    ``df`` may read the dataset itself: new files are staged, and folders change when the job commits. A
    partition that ``df`` has no row for is left as it is, even if all of its rows went.
    """
    (
        df.hint("rebalance", F.col(partition))
        .sortWithinPartitions(partition, cluster)
        .write.partitionBy(partition)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def _in_partitions(partition: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    found = F.col(partition).isin(known) if known else F.lit(False)
    return found | F.col(partition).isNull() if None in values else found


def _values(rows: DataFrame, partition: str) -> list:
    """The partitions that ``rows`` are in; as many as there are folders at most."""
    return [r[0] for r in rows.select(partition).distinct().collect()]


def update_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str,
    cluster: str,
    column: str,
    value: Column,
    condition: Column,
) -> list:
    """Set ``column`` where ``condition`` holds, reading and writing only the partitions it holds in; they are
    returned. ``column`` must not be the partition column."""
    stored = spark.read.schema(schema).parquet(path)
    touched = _values(stored.where(condition), partition)
    if touched:
        rows = stored.where(_in_partitions(partition, touched))
        overwrite_partitions(update_where(rows, column, value, condition), path, partition, cluster)
    return touched


def merge_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str,
    cluster: str,
    changes: DataFrame,
    key: str,
    sequence: list[str],
) -> list:
    """Apply inserts, updates and deletes by key (see :func:`heronry.operators.keyed.apply_changes`) to the
    partitions that ``changes`` name, which are returned; the partition of a key must never change.

    Only those partitions are read, joined and written. One whose rows are all deleted is not overwritten by
    what is left, so its folder is removed afterwards. ``changes`` may read the dataset: it is stored first.
    """
    changes = materialize(changes, "changes")
    touched = _values(changes, partition)
    if not touched:
        return touched
    stored = spark.read.schema(schema).parquet(path).where(_in_partitions(partition, touched))
    overwrite_partitions(
        apply_changes(stored, changes, key, sequence).select(*[f.name for f in schema]), path, partition, cluster
    )
    # Partitions of which no row is left were not overwritten: what they still hold is deleted by the changes.
    after = spark.read.schema(schema).parquet(path).where(_in_partitions(partition, touched))
    last = changes.groupBy(key).agg(F.max(F.struct(*sequence, "action")).alias("last"))
    gone = last.where(F.col("last.action") == "delete").select(key)
    left = {r[0] for r in after.join(gone, key, "left_semi").select(partition).distinct().collect()}
    jvm = spark.sparkContext._jvm
    for value in left:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
