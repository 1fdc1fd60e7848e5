"""Versioned snapshots of a dataset: ``root/version=N``. A version counts once Spark has committed
it, so a reader never sees a half-written one, and rewriting a version is harmless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def committed(spark: SparkSession, root: str, key: str = "version") -> list[int]:
    """Numbers of the committed versions, ascending. Lists folders only, no data."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{key}=*/_SUCCESS")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName().split("=", 1)[1]) for f in found)


def _taken(spark: SparkSession, root: str, key: str = "version") -> int:
    """The highest number that a version, committed or not, has; 0 if there is none."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{key}=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return max((int(f.getPath().getName().split("=", 1)[1]) for f in found), default=0)


def remove_versions(spark: SparkSession, root: str, numbers: list[int], key: str = "version") -> None:
    """Delete versions that nobody reads any more."""
    jvm = spark.sparkContext._jvm
    for number in numbers:
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{key}={number}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_version(df: DataFrame, root: str, version: int, key: str = "version") -> None:
    """Write (or rewrite) one version."""
    df.write.mode("overwrite").parquet(f"{root}/{key}={version}")


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """One version, by default the newest, with the columns that version has."""
    known = committed(spark, root)
    if not known:
        raise LookupError(f"no committed version under {root}")
    return spark.read.parquet(f"{root}/version={known[-1] if version is None else version}")


def next_version(df: DataFrame, root: str) -> int:
    """Write ``df`` as the version after the newest. ``df`` may read the newest version itself.

    The number of a version that was never finished is not used again. If another writer takes the
    number meanwhile, this one fails and leaves that version alone.
    """
    version = _taken(df.sparkSession, root) + 1
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
    return version


def history(spark: SparkSession, root: str) -> DataFrame:
    """Version and row count of every committed version. Reads file footers only."""
    paths = [f"{root}/version={v}" for v in committed(spark, root)]
    if not paths:
        raise LookupError(f"no committed version under {root}")
    rows = spark.read.option("basePath", root).parquet(*paths)
    return rows.groupBy(F.col("version").cast("bigint").alias("version")).agg(
        F.count("*").alias("row_count")
    )
