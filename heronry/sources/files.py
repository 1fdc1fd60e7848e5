"""Readers for landed files: CSV, JSON payloads, captions, versioned records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from heronry.functions.texts import strip_names
from heronry.functions.times import to_moment
from heronry.session import materialize


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    trim: bool = True,
) -> DataFrame:
    """CSV with a header. Declare ``schema`` for large inputs: inferring types reads everything twice.

    ``trim`` removes blanks around values, so ``"West "`` and ``"West"`` are one region.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header, every column left as text."""
    return spark.read.option("header", True).csv(path)


def read_csv_dated(spark: SparkSession, path: str | list[str], date_column: str) -> DataFrame:
    """CSV with blanks around the header names removed and one column parsed as a date.

    The other columns stay text and are coerced where they are used.
    """
    df = strip_names(read_csv_text(spark, path))
    return df.withColumn(date_column, to_moment(F.trim(date_column)).cast("timestamp_ntz"))


def read_csv_capped(
    spark: SparkSession, path: str, schema: str, max_bad: int, header: bool = False
) -> DataFrame:
    """CSV under a declared schema, tolerating up to ``max_bad`` records that do not fit it.

    The text is parsed once, into the shared folder, and bad records are counted on the way; more of them than
    allowed are an error.
    """
    raw = (
        spark.read.option("header", header)
        .option("columnNameOfCorruptRecord", "__bad")
        .schema(f"{schema}, __bad string")
        .csv(path)
    )
    seen = Observation()
    parsed = materialize(raw.observe(seen, F.count("__bad").alias("bad")), "csv-load")
    bad = seen.get["bad"]
    if bad > max_bad:
        raise ValueError(f"{bad} bad records in {path}, at most {max_bad} allowed")
    return parsed.where(F.col("__bad").isNull()).drop("__bad")


def read_payload_records(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """Landed API responses that are lists of objects: one row per object.

    One response per line keeps files splittable; ``multi_line`` reads pretty-printed responses.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_payload_object(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    nested: str,
    multi_line: bool = False,
) -> DataFrame:
    """Landed API responses with a nested object: its fields beside the outer ones.

    A field missing from the response is null.
    """
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    outer = [c for c in df.columns if c != nested]
    return df.select(f"{nested}.*", *outer)


def read_captions(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Caption files, one row each. ``separator`` reads bundles that hold many captions per file."""
    if separator is None:
        return spark.read.text(path, wholetext=True).withColumnRenamed("value", "captions")
    return spark.read.text(path, lineSep=separator).withColumnRenamed("value", "captions")


def read_versions(spark: SparkSession, paths: list[str], newest: T.StructType) -> DataFrame:
    """Records written under older and newer schemas, read as the newest one.

    Passing the newest schema avoids opening every footer, which ``mergeSchema`` would do; a field
    that a file does not have is null.
    """
    return spark.read.schema(newest).parquet(*paths)


def read_table(spark: SparkSession, name: str, fmt: str | None = None, **options: str) -> DataFrame:
    """A named table: from the catalog, or through a connector when ``fmt`` is given."""
    if fmt is None:
        return spark.table(name)
    return spark.read.format(fmt).options(**options).load(name)
