"""File and table writers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from heronry.functions.times import run_folder

def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with headers, as many files as there are partitions.

    ``single`` writes one file through one task. That is the caller's choice, for a report whose size the
    caller knows: a result that grows with the data belongs in several files. What comes before runs
    in parallel all the same, since its rows are dealt to the one task by a shuffle.
    """
    out = df.repartition(1) if single else df
    out.write.option("header", True).mode("overwrite").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace a parquet result."""
    df.write.mode("overwrite").parquet(path)


def write_run(df: DataFrame, root: str, run_at: datetime) -> str:
    """Write one run under ``root/yyyy/MM/dd/HHmm``; a repeated run replaces its own folder."""
    path = f"{root}/{run_folder(run_at)}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Append rows to a dataset."""
    df.write.format(fmt).options(**options).mode("append").save(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append observations to a CSV dataset. Headers belong to files, so readers never see one twice."""
    df.write.option("header", True).mode("append").csv(path)


def replace_table(df: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a dataset, warehouse table or relational table with a full recompute.

    ``fmt`` and ``options`` name the connector, for example ``jdbc`` with ``url`` and ``dbtable``.
    """
    writer = df.write.format(fmt).options(**options).mode("overwrite")
    writer.save(target) if target else writer.save()


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table; with ``path`` its files live outside the warehouse folder."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_partitioned(
    df: DataFrame, path: str, partition: str, cluster: str, mode: str = "append"
) -> None:
    """Dataset partitioned by ``partition`` and clustered by ``cluster`` inside it; created when missing.

    The rebalance hint brings a partition value together for few files, and lets adaptive execution
    split a value that is too big for one task.
    """
    (
        df.hint("rebalance", F.col(partition))
        .sortWithinPartitions(partition, cluster)
        .write.partitionBy(partition)
        .mode(mode)
        .parquet(path)
    )
