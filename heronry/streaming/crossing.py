"""Running totals that leave a stream only when they change, or when they cross a bound.

A call of Python for every key would cost milliseconds a key and batch. The state therefore holds the totals of a
bucket of keys as one Arrow table, and a batch makes one call for each bucket that it has rows of.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from heronry.functions.numbers import beyond_units, in_units

# What runs in the tasks travels by value, so executors need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A batch rewrites the totals of the buckets it has rows of. Checkpoints hold this number: with another one a stream
# would not find its totals again.
BUCKETS = 1024
# Sums that a task holds before they go into the shuffle.
HELD = 2**18


def _sums(table: pa.Table) -> pa.Table:
    """One row for each key, null included."""
    sums = table.group_by("key", use_threads=False).aggregate([("units", "sum"), ("rest", "sum")])
    return sums.select(["key", "units_sum", "rest_sum"]).rename_columns(["key", "units", "rest"])


def presummed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by key over as many Arrow batches as fit into ``HELD`` rows, so that a hot key sends few rows through the
    shuffle."""
    held, rows = [], 0
    for batch in batches:
        held.append(_sums(pa.Table.from_batches([batch])))
        rows += held[-1].num_rows
        if rows >= HELD:
            held = [_sums(pa.concat_tables(held))]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from _sums(pa.concat_tables(held)).to_batches()


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _adder(scale: int, above: float | None, ttl_ms: int):
    """Adds the sums of a batch to the totals of a bucket of keys and hands on the new ones: all that have changed,
    or only those that have crossed ``above`` upward or downward."""
    size = float(10**scale)
    sums = pa.schema([("key", pa.string()), ("units", pa.int64()), ("rest", pa.float64())])
    # The batch time up to which a total is kept without rows; 0: for good.
    totals = sums.append(pa.field("until", pa.int64()))

    def add(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        time = state.getCurrentProcessingTimeMs()
        held = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else totals.empty_table()
        own = sums.empty_table()
        for part in parts:
            rows = [pa.array(part[f.name].to_numpy(), f.type) for f in sums]
            own = _sums(pa.concat_tables([own, pa.table(rows, schema=sums)]))
        # A key that comes back is matched before idle ones are forgotten: it has rows in this batch.
        at = pc.index_in(own["key"], value_set=held["key"])
        units, rest = (pc.fill_null(held[c].take(at), 0) for c in ("units", "rest"))
        before = units.to_numpy() / size + rest.to_numpy()
        units, rest = pc.add_checked(units, own["units"]), pc.add(rest, own["rest"])
        now = units.to_numpy() / size + rest.to_numpy()
        idle = pc.invert(pc.is_in(held["key"], value_set=own["key"]))
        if ttl_ms:
            alive = pc.or_(pc.equal(held["until"], 0), pc.greater_equal(held["until"], time))
            idle = pc.and_(idle, alive)
        until = pa.repeat(time + ttl_ms if ttl_ms else 0, own.num_rows)
        added = pa.table([own["key"], units, rest, until], schema=totals)
        kept = pa.concat_tables([held.filter(idle), added]).combine_chunks()
        if kept.num_rows:
            state.update((_packed(kept),))
            first = pc.min(kept["until"].filter(pc.greater(kept["until"], 0))).as_py()
            if ttl_ms and first is not None:
                state.setTimeoutDuration(max(1, first - time))
        else:
            state.remove()
        keys = own["key"].to_numpy()
        if above is None:
            yield pd.DataFrame({"key": keys, "total": now})
        else:
            crossed = (before > above) != (now > above)
            if crossed.any():
                yield pd.DataFrame({"key": keys[crossed], "total": now[crossed], "above": now[crossed] > above})

    return add


def _as_text(key: Column, kind: str) -> Column:
    """A key as text that differs exactly where the key does."""
    if kind == "binary":
        return F.hex(key)
    if kind == "timestamp":
        return F.unix_micros(key).cast("string")
    # The two zeros of a double are one key.
    return (key + F.lit(0.0).cast(kind) if kind in ("float", "double") else key).cast("string")


def _from_text(text: Column, kind: str) -> Column:
    if kind == "binary":
        return F.unhex(text)
    return F.timestamp_micros(text.cast("long")) if kind == "timestamp" else text.cast(kind)


def _totals(stream: DataFrame, key: str, value: str, scale: int, above: float | None, ttl_ms: int) -> DataFrame:
    kind = stream.schema[key].dataType.simpleString()
    known = stream.where(F.col(value).isNotNull()).select(
        F.col(key).alias("key"),
        in_units(F.col(value), scale).cast("long").alias("units"),
        beyond_units(F.col(value), scale).alias("rest"),
    )
    sums = known.mapInArrow(presummed, f"key {kind}, units long, rest double").withColumn(
        "key", _as_text(F.col("key"), kind)
    )
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    return (
        sums.withColumn("bucket", F.coalesce(F.crc32("key") % BUCKETS, F.lit(0)))
        .groupBy("bucket")
        .applyInPandasWithState(
            _adder(scale, above, ttl_ms),
            "key string, total double" + ("" if above is None else ", above boolean"),
            "totals binary",
            "update",
            timeout,
        )
        .withColumn("key", _from_text(F.col("key"), kind))
        # There is a total for every key; pandas hands NaN on as null.
        .withColumn("total", F.coalesce("total", F.lit(float("nan"))))
        .withColumnRenamed("key", key)
    )


def changed_totals(stream: DataFrame, key: str, value: str, scale: int = 2, ttl_ms: int = 0) -> DataFrame:
    """(key, total) of the keys that a batch has rows of, with their sum since the stream began. Null values count
    as no rows, NaN makes a total NaN; rows without a key are a key of their own. Sums are of whole units of
    ``10 ** -scale`` and what lies beyond them, so for fixed-point values the order of rows does not matter. A key
    without rows for ``ttl_ms`` (0: any time) is forgotten by the next batch without it and starts from zero when it
    comes back. Spark then runs batches without data, so with ``ttl_ms`` use an interval as the trigger, or turn those
    batches off."""
    return _totals(stream, key, value, scale, None, ttl_ms)


def crossings(
    stream: DataFrame, key: str, value: str, above: float, scale: int = 2, ttl_ms: int = 0
) -> DataFrame:
    """(key, total, above) of the keys whose sum has crossed the bound in a batch; a sum equal to the bound, or NaN,
    is not above it. All other keys stay silent, however many rows they have. A key forgotten after ``ttl_ms`` is
    below the bound again."""
    return _totals(stream, key, value, scale, above, ttl_ms)
