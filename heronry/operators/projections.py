"""Projections: renames, splits, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns in one projection."""
    return df.withColumnsRenamed(names)


def split_columns(
    df: DataFrame, parts: dict[str, list[str]], unique_by: dict[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """Cut a wide table into narrower ones by column lists.

    Every part keeps one row per input row. ``unique_by`` asks for one row per key in a part.
    """
    split = {name: df.select(*columns) for name, columns in parts.items()}
    for name, keys in (unique_by or {}).items():
        split[name] = split[name].dropDuplicates(keys)
    return split


def flatten(df: DataFrame, nested: str, prefix: str = "") -> DataFrame:
    """Replace a struct column by its fields."""
    fields = df.schema[nested].dataType.names
    flat = [F.col(f"{nested}.{f}").alias(f"{prefix}{f}") for f in fields]
    return df.select(*[c for c in df.columns if c != nested], *flat)


def reshape_click(
    df: DataFrame, duration: str = "duration", moment: str = "timestamp", **names: str
) -> DataFrame:
    """One click as one countable activity row."""
    return df.select(
        F.col(names.get("user", "user_id")).alias("user_id"),
        F.col(names.get("page", "page")).alias("page"),
        F.col(names.get("action", "action")).alias("action"),
        F.lit(1).alias("count"),
        F.col(duration).cast("double").alias("total_duration"),
        F.col(moment).alias("processing_time"),
        F.col(names.get("device", "device")).alias("device"),
    )


def with_total_value(df: DataFrame, price: str = "price", stock: str = "stock") -> DataFrame:
    """Add the value of the stock."""
    return df.withColumn("total_value", F.col(price) * F.col(stock))


def with_net(df: DataFrame, gross: Column, net) -> DataFrame:
    """Add gross and net amounts; ``net`` maps the gross column to the net one."""
    return df.withColumn("gross_amount", gross).withColumn("net_amount", net(F.col("gross_amount")))


def stamp(df: DataFrame, column: str = "processing_time") -> DataFrame:
    """Add the time of processing. For streams only: it differs from run to run."""
    return df.withColumn(column, F.current_timestamp())
