"""Schema resolution: which versions of a schema can read which, and reading old rows under a new schema.

A field may declare in its metadata a ``default``, the ``aliases`` it had before, and that it is ``required``.
Spark keeps this metadata in the files, so a dataset's versions tell their schemas themselves.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from heronry.sinks import versions

# Each of these types can be read as any later one.
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
# Decimal digits that hold every value of an integral type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
RULES = ("BACKWARD", "FORWARD", "FULL")
TRANSITIVE = "_TRANSITIVE"


class IncompatibleSchema(ValueError):
    """A schema that the rule of a dataset does not allow beside its versions."""


def field(
    name: str, kind: str | T.DataType, *aliases: str, required: bool = False, **default: object
) -> T.StructField:
    """A field with its former names; ``default=...`` is the value in rows that lack it."""
    kind = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    declared: dict[str, object] = {}
    if aliases:
        declared["aliases"] = list(aliases)
    if required:
        declared["required"] = True
    if "default" in default:
        declared["default"] = json.dumps(default["default"])
    return T.StructField(name, kind, True, declared)


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the metadata that ``schema`` declares; columns go by name."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])


def promotes(writer: T.DataType, reader: T.DataType) -> bool:
    """Whether every value of an unnested type ``writer`` can be read as ``reader``."""
    if writer == reader:
        return True
    if type(writer) in NUMBERS and type(reader) in NUMBERS:
        return NUMBERS.index(type(writer)) < NUMBERS.index(type(reader))
    if isinstance(reader, T.DecimalType):
        whole = reader.precision - reader.scale
        if isinstance(writer, T.DecimalType):
            return reader.scale >= writer.scale and whole >= writer.precision - writer.scale
        return whole >= DIGITS.get(type(writer), 99)
    pair = (type(writer), type(reader))
    return pair in {
        (T.StringType, T.BinaryType),
        (T.BinaryType, T.StringType),
        (T.DateType, T.TimestampNTZType),
    }


def _source(wanted: T.StructField, writer: T.StructType) -> T.StructField | None:
    """The writer's field that a reader's field takes its values from: by name, else by a former one."""
    by_name = {f.name: f for f in writer}
    names = [wanted.name, *wanted.metadata.get("aliases", [])]
    return next((by_name[n] for n in names if n in by_name), None)


def problems(reader: T.DataType, writer: T.DataType, at: str = "") -> list[str]:
    """Why rows written as ``writer`` cannot be read as ``reader``; empty if they can.

    A field is found by name or alias and must promote to the reader's type, in structs, arrays and maps too. A
    field that the writer lacks needs a default, a required one must be required by the writer as well.
    """
    if isinstance(reader, T.StructType) and isinstance(writer, T.StructType):
        found: list[str] = []
        for f in reader:
            name = f"{at}.{f.name}" if at else f.name
            source = _source(f, writer)
            if source is None:
                if "default" not in f.metadata:
                    found.append(f"{name} is missing and has no default")
                continue
            if f.metadata.get("required") and not source.metadata.get("required"):
                found.append(f"{name} may be null")
            found += problems(f.dataType, source.dataType, name)
        return found
    if isinstance(reader, T.ArrayType) and isinstance(writer, T.ArrayType):
        return problems(reader.elementType, writer.elementType, f"{at}[]")
    if isinstance(reader, T.MapType) and isinstance(writer, T.MapType):
        keys = problems(reader.keyType, writer.keyType, f"{at} keys")
        return keys + problems(reader.valueType, writer.valueType, f"{at} values")
    if promotes(writer, reader):
        return []
    return [f"{at} is {writer.simpleString()} and not {reader.simpleString()}"]


def violations(newer: T.StructType, earlier: list[T.StructType], rule: str) -> list[str]:
    """What ``rule`` has against ``newer`` as the version after ``earlier`` (oldest first).

    ``BACKWARD``: the new schema reads old rows. ``FORWARD``: the old schema reads new rows. ``FULL``: both. The
    latest version counts, or with ``_TRANSITIVE`` every one.
    """
    plain = rule.removesuffix(TRANSITIVE)
    if plain not in RULES:
        raise ValueError(f"no rule {rule}")
    found: list[str] = []
    for old in earlier if rule.endswith(TRANSITIVE) else earlier[-1:]:
        if plain in ("BACKWARD", "FULL"):
            found += problems(newer, old)
        if plain in ("FORWARD", "FULL"):
            found += problems(old, newer)
    return list(dict.fromkeys(found))


def version_schemas(spark: SparkSession, root: str) -> dict[int, T.StructType]:
    """The schema of each committed version of a dataset, from the footer of its files."""
    return {v: versions.read_version(spark, root, v).schema for v in versions.committed(spark, root)}


def append_version(df: DataFrame, root: str, rule: str) -> int:
    """Write ``df`` as the next version of a dataset, unless ``rule`` has something against its schema: then
    nothing is written and :class:`IncompatibleSchema` tells why."""
    known = version_schemas(df.sparkSession, root)
    against = violations(df.schema, [known[v] for v in sorted(known)], rule)
    if against:
        raise IncompatibleSchema(f"{rule}: {'; '.join(against)}")
    return versions.next_version(df, root)


def _fitted(value: Column, writer: T.DataType, reader: T.DataType) -> Column:
    """A value of type ``writer`` as one of type ``reader``."""
    if isinstance(reader, T.StructType):
        made = F.struct(*[_field(f, writer, lambda n: value.getField(n)).alias(f.name) for f in reader])
        return F.when(value.isNotNull(), made)
    if isinstance(reader, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, writer.elementType, reader.elementType))
    if isinstance(reader, T.MapType):
        values = F.transform_values(value, lambda _, x: _fitted(x, writer.valueType, reader.valueType))
        return values.cast(reader)
    return value.cast(reader)


def _field(wanted: T.StructField, writer: T.StructType, get) -> Column:
    source = _source(wanted, writer)
    if source is not None:
        return _fitted(get(source.name), source.dataType, wanted.dataType)
    default = json.loads(wanted.metadata["default"])
    if default is None or isinstance(default, (bool, int, float, str)):
        return F.lit(default).cast(wanted.dataType)
    return F.from_json(F.lit(json.dumps(default)), wanted.dataType)


def resolved(df: DataFrame, reader: T.StructType) -> DataFrame:
    """Rows of an older or newer version as ``reader`` declares them: fields by name or alias, promoted,
    defaults where the version lacks one, and no others. One projection, so scans read only what is used."""
    against = problems(reader, df.schema)
    if against:
        raise IncompatibleSchema("; ".join(against))
    return df.select(
        *[
            _field(f, df.schema, lambda n: F.col(f"`{n}`")).alias(f.name, metadata=f.metadata)
            for f in reader
        ]
    )


def read_resolved(spark: SparkSession, root: str, reader: T.StructType, only: Iterable[int] | None = None) -> DataFrame:
    """All versions of a dataset (or ``only`` some) as ``reader`` declares them."""
    numbers = versions.committed(spark, root) if only is None else only
    first, *others = [resolved(versions.read_version(spark, root, v), reader) for v in numbers]
    for other in others:
        first = first.unionAll(other)
    return first


def absent_fields(spark: SparkSession, root: str, reader: T.StructType) -> DataFrame:
    """(version, field, row_count, null_count, absent_count): for each version of a dataset and each field of
    ``reader``, the rows whose field is null and the rows that have no such field at all. One pass over each
    version reads only the columns in question."""
    made: DataFrame | None = None
    for number in versions.committed(spark, root):
        rows = versions.read_version(spark, root, number)
        sources = {f.name: _source(f, rows.schema) for f in reader}
        total = F.count(F.lit(1))
        counts = [
            F.struct(
                F.lit(name).alias("field"),
                (F.lit(0) if s is None else F.count_if(F.col(f"`{s.name}`").isNull())).cast("long").alias("null_count"),
                (total if s is None else F.lit(0)).cast("long").alias("absent_count"),
            )
            for name, s in sources.items()
        ]
        report = (
            rows.agg(total.alias("row_count"), F.array(*counts).alias("fields"))
            .select(F.lit(number).cast("long").alias("version"), "row_count", F.explode("fields").alias("f"))
            .select("version", "f.field", "row_count", "f.null_count", "f.absent_count")
        )
        made = report if made is None else made.unionAll(report)
    if made is None:
        raise LookupError(f"no committed version under {root}")
    return made
