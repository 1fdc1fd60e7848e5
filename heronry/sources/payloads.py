"""Payloads whose fields nobody has declared: JSON text kept as a variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_payloads(spark: SparkSession, path: str | list[str], payload: str = "payload") -> DataFrame:
    """One JSON value a line: ``payload`` is the value whatever its fields, ``bad`` the text that is no JSON, else null.
    No schema is declared or inferred, so the text is read once. Blank lines are left out."""
    text = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    return text.select(parsed.alias(payload), F.when(parsed.isNull(), F.col("value")).alias("bad"))


def field_of(payload: str, path: str, kind: str) -> Column:
    """The value at a path such as ``$.props.k`` as ``kind``; null where it is absent, null or of a type that cannot be
    cast."""
    return F.try_variant_get(F.col(payload), path, kind)


def field_types(df: DataFrame, payload: str, declared: dict[str, str]) -> DataFrame:
    """(field, type, status, row_count): the outermost fields that the payloads have, with the types of their values.

    ``declared`` maps the known fields to the type each should have (``BIGINT``, ``DECIMAL``, ``STRING``, ``OBJECT``,
    ...). The status is ``declared``, ``null`` for null values, ``other type`` or ``unknown`` for a field that nobody
    declared. Payloads that are no objects have no fields. Counts are combined before the shuffle.
    """
    spark = df.sparkSession
    exploded = df.select(F.col(payload).alias("__payload")).lateralJoin(
        spark.tvf.variant_explode(F.col("__payload").outer())
    )
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    known = F.create_map(*[F.lit(x) for pair in declared.items() for x in pair]) if declared else F.create_map()
    wanted = F.get(F.array(F.element_at(known, F.col("field"))), 0) if declared else F.lit(None).cast("string")
    status = (
        F.when(F.col("type") == "VOID", "null")
        .when(wanted.isNull(), "unknown")
        .when(wanted == F.col("type"), "declared")
        .otherwise("other type")
    )
    return (
        exploded.where(F.col("key").isNotNull())
        .groupBy(F.col("key").alias("field"), kind.alias("type"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("field", "type", status.alias("status"), "row_count")
    )
