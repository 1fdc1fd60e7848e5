"""Declared, inferred and evolving schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Column names that hold fractional numbers.
FRACTION_NAMES = ("unit_price", "discount_applied", "distance_to_store")


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fit rows to a declared schema in one projection: cast, reorder, add missing columns as null,
    drop undeclared ones. Values that cannot be cast become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def require(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a value in every required column, and the rest."""
    complete: Column = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.where(complete), df.where(~complete)


def union_versions(*versions: DataFrame) -> DataFrame:
    """Rows of several schema versions as one table; a field a version lacks is null."""
    first, *others = versions
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def drift_report(df: DataFrame, version: str, newest: list[str]) -> DataFrame:
    """Per version: rows, and rows that lack each field of the newest schema."""
    return df.groupBy(version).agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"without_{c}") for c in newest],
    )


def type_by_name(name: str) -> T.DataType:
    """Column type guessed from the column name."""
    if "id" in name or "number" in name:
        return T.LongType()
    if "date" in name:
        return T.TimestampNTZType()
    if name in FRACTION_NAMES:
        return T.DoubleType()
    return T.StringType()


def cast_by_name(df: DataFrame) -> DataFrame:
    """Every column cast to the type its name suggests; uncastable values become null."""
    return df.select(*[F.col(f"`{c}`").try_cast(type_by_name(c)).alias(c) for c in df.columns])
