"""Totals that leave a stream on change or on crossing, start positions, payloads without a declared schema."""

import itertools
import zlib
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heronry.session import fresh_path
from heronry.sinks.files import append_rows
from heronry.sources import payloads
from heronry.sources.positions import stream_numbered
from heronry.streaming import crossing, jobs, runs

ROW = "key string, amount double"


def emitted(spark, deliveries, make):
    """What leaves each of several batches, with a restart before each."""
    root = fresh_path(spark, "crossing")
    for rows in deliveries:
        spark.createDataFrame(rows, ROW).repartition(3).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(ROW).parquet(f"{root}/landed")
        handler = jobs.changes_to(f"{root}/out")
        runs.finish(runs.to_batches(make(stream), handler, f"{root}/progress", "update"))
    return sorted(map(tuple, jobs.stored_rows(spark, f"{root}/out").collect()), key=str)


DELIVERIES = [
    [("a", 60.0), ("a", 50.0), ("b", 99.99), (None, 500.0), ("c", None), ("d", 100.0)],
    [("a", -20.0), ("b", 0.01), ("e", 1.0)],
    [("a", 10.0), ("a", 5.0), ("b", 0.01), ("d", 0.005), ("e", None)],
]


def test_only_changed_totals_leave(spark):
    got = emitted(spark, DELIVERIES, lambda s: crossing.changed_totals(s, "key", "amount"))
    want = [
        ("a", 110.0, 0), ("b", 99.99, 0), (None, 500.0, 0), ("d", 100.0, 0), ("a", 90.0, 1), ("b", 100.0, 1),
        ("e", 1.0, 1), ("a", 105.0, 2), ("b", 100.01, 2), ("d", 100.005, 2),
    ]
    assert got == sorted(want, key=str)


def test_only_crossings_leave(spark):
    got = emitted(spark, DELIVERIES, lambda s: crossing.crossings(s, "key", "amount", 100.0))
    want = [
        ("a", 110.0, True, 0), (None, 500.0, True, 0), ("a", 90.0, False, 1), ("a", 105.0, True, 2),
        ("b", 100.01, True, 2), ("d", 100.005, True, 2),
    ]
    assert got == sorted(want, key=str)


def test_totals_with_a_time_to_live(spark):
    """An idle key is forgotten by a later batch; a key with rows is not."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        rows = [[("a", 60.0), ("b", 1.0)], [("b", 2.0)], [("a", 5.0), ("b", 4.0)]]
        got = emitted(spark, rows, lambda s: crossing.changed_totals(s, "key", "amount", ttl_ms=1))
        want = [("a", 60.0, 0), ("b", 1.0, 0), ("b", 3.0, 1), ("a", 5.0, 2), ("b", 7.0, 2)]
        assert got == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_a_hot_key_is_one_row_of_a_batch():
    batch = pa.table({"key": ["a"] * 1000 + ["b"], "units": [2] * 1001, "rest": [0.5] * 1001}).to_batches()[0]
    made = [r for b in crossing.presummed(iter([batch])) for r in b.to_pylist()]
    assert sorted(made, key=lambda r: r["key"]) == [
        {"key": "a", "units": 2000, "rest": 500.0}, {"key": "b", "units": 2, "rest": 0.5}
    ]


def test_a_hot_key_is_few_rows_of_a_task():
    """A key is one row of many Arrow batches; where most keys are new, sums go on before the task ends."""
    batch = lambda keys: pa.table(
        {"key": keys, "units": [1] * len(keys), "rest": [0.0] * len(keys)}
    ).to_batches()[0]
    made = [r for b in crossing.presummed(batch(["a", "b", None]) for _ in range(50)) for r in b.to_pylist()]
    assert sorted(((r["key"], r["units"]) for r in made), key=str) == [("a", 50), ("b", 50), (None, 50)]
    step = crossing.HELD // 8
    sent = [b.num_rows for b in crossing.presummed(batch(range(n * step, (n + 1) * step)) for n in range(20))]
    assert sum(sent) == 20 * step and max(sent) <= crossing.HELD


def test_many_keys_are_few_calls(spark):
    """State and calls of Python go by bucket, so a batch of 20,000 keys does not make as many calls."""
    root, held = fresh_path(spark, "crossing-many"), []
    for amount in ("cast(id as double)", "-0.5D"):
        rows = spark.range(20000).select(F.col("id").alias("key"), F.expr(amount).alias("amount"))
        rows.repartition(3).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landed")
        crossed = crossing.crossings(stream, "key", "amount", 15000.0)
        run = runs.finish(runs.to_batches(crossed, jobs.changes_to(f"{root}/out"), f"{root}/progress", "update"))
        held.append(run.recentProgress[0]["stateOperators"][0]["numRowsTotal"])
    out = jobs.stored_rows(spark, f"{root}/out")
    want = [(k, float(k), True, 0) for k in range(15001, 20000)]
    assert out.count() == len(want) and set(map(tuple, out.where("batch_id = 0").collect())) == set(want)
    assert max(held) <= crossing.BUCKETS


def same_bucket(count):
    """Text keys whose totals lie in one bucket."""
    keys = (f"k{n}" for n in range(100000) if zlib.crc32(f"k{n}".encode()) % crossing.BUCKETS == 7)
    return list(itertools.islice(keys, count))


def test_keys_of_a_bucket_keep_their_own_totals(spark):
    a, b, c = same_bucket(3)
    rows = [[(a, 60.0), (b, 99.0), (a, 50.0)], [(b, 1.0), (c, 101.0)], [(a, -10.0), (b, 0.01)], [(c, -1.5)]]
    got = emitted(spark, rows, lambda s: crossing.crossings(s, "key", "amount", 100.0))
    want = [(a, 110.0, True, 0), (c, 101.0, True, 1), (a, 100.0, False, 2), (b, 100.01, True, 2), (c, 99.5, False, 3)]
    assert got == sorted(want, key=str)


def test_keys_of_a_bucket_are_forgotten_one_by_one(spark):
    """An idle key is forgotten though another key of its bucket has rows in every batch."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        a, b = same_bucket(2)
        rows = [[(a, 60.0), (b, 1.0)], [(b, 2.0)], [(a, 5.0), (b, 4.0)], [("else", 1.0)], [(a, 7.0), (b, 8.0)]]
        got = emitted(spark, rows, lambda s: crossing.changed_totals(s, "key", "amount", ttl_ms=1))
        want = [
            (a, 60.0, 0), (b, 1.0, 0), (b, 3.0, 1), (a, 5.0, 2), (b, 7.0, 2), ("else", 1.0, 3), (a, 7.0, 4),
            (b, 8.0, 4),
        ]
        assert got == sorted(want, key=str)
        kept = emitted(spark, rows, lambda s: crossing.changed_totals(s, "key", "amount", ttl_ms=3_600_000))
        assert [r for r in kept if r[2] == 4] == sorted([(a, 72.0, 4), (b, 15.0, 4)], key=str)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_a_total_of_nan_stays_nan(spark):
    rows = [[("a", float("nan")), ("a", 1.005), ("b", 500.0)], [("a", 500.0), ("b", float("nan"))]]
    got = emitted(spark, rows, lambda s: crossing.changed_totals(s, "key", "amount"))
    want = [("a", float("nan"), 0), ("b", 500.0, 0), ("a", float("nan"), 1), ("b", float("nan"), 1)]
    assert list(map(repr, got)) == sorted(map(repr, want))
    got = emitted(spark, rows, lambda s: crossing.crossings(s, "key", "amount", 100.0))
    assert list(map(repr, got)) == ["('b', 500.0, True, 0)", "('b', nan, False, 1)"]


@pytest.mark.parametrize(
    "kind, key",
    [
        ("bigint", 2**53 + 1), ("double", -0.0), ("date", date(2024, 2, 29)), ("binary", b"\xff\x00"),
        ("timestamp", datetime(2024, 1, 1, 1, 2, 3, 4)), ("decimal(20,2)", Decimal("123456789012345678.91")),
    ],
)
def test_keys_of_any_type(spark, kind, key):
    root = fresh_path(spark, "crossing-kinds")
    for _ in range(2):
        rows = spark.createDataFrame([(key, 60.0), (None, 1.0)], f"key {kind}, amount double")
        rows.write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landed")
        made = crossing.changed_totals(stream, "key", "amount")
        assert made.schema["key"].dataType == rows.schema["key"].dataType
        runs.finish(runs.to_batches(made, jobs.changes_to(f"{root}/out"), f"{root}/progress", "update"))
    got = {tuple(r) for r in jobs.stored_rows(spark, f"{root}/out").collect()}
    assert got == {(key, 60.0, 0), (None, 1.0, 0), (key, 120.0, 1), (None, 2.0, 1)}


# --- start positions


def run_to(spark, root, name, start):
    stream = stream_numbered(spark, f"{root}/landed", spark.range(0).schema, "id", start)
    return runs.to_files(stream, f"{root}/{name}", f"{root}/{name}-progress", runs.every("0 seconds"))


@pytest.mark.parametrize("start, first", [("earliest", 0), ("latest", 100), (41, 42), (1000, 201)])
def test_start_counts_once(spark, start, first):
    root = fresh_path(spark, "positions")
    append_rows(spark.range(100).repartition(3), f"{root}/landed")
    run = run_to(spark, root, "out", start)
    run.processAllAvailable()
    append_rows(spark.range(100, 200), f"{root}/landed")
    run.processAllAvailable()
    run.stop()
    out = spark.read.schema("id long").parquet(f"{root}/out") if first < 200 else spark.range(0)
    assert sorted(r.id for r in out.collect()) == list(range(min(first, 200), 200))
    if first < 200:
        # The start of a stream with a checkpoint does not count.
        append_rows(spark.range(200, 250), f"{root}/landed")
        run = run_to(spark, root, "out", 5000)
        run.processAllAvailable()
        run.stop()
        again = spark.read.schema("id long").parquet(f"{root}/out")
        assert sorted(r.id for r in again.collect()) == list(range(first, 250))


# --- payloads without a declared schema


def test_payloads_of_any_shape(spark):
    path = fresh_path(spark, "payloads")
    lines = ['{"a": 1, "b": {"c": [1, 2]}}', '{"a": "7"}', '{"a": null}', "[1, 2]", "3", '{"a": ', "", "   ", "null"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    rows = payloads.read_payloads(spark, path)
    shown = rows.select(
        payloads.field_of("payload", "$.a", "int").alias("a"),
        payloads.field_of("payload", "$.b.c[1]", "int").alias("c"),
        "bad",
    )
    got = sorted(map(tuple, shown.collect()), key=str)
    want = [(1, 2, None), (7, None, None), (None, None, '{"a": ')] + [(None, None, None)] * 4
    assert got == sorted(want, key=str)
    types = payloads.field_types(rows, "payload", {"a": "BIGINT"}).collect()
    assert sorted(map(tuple, types)) == [
        ("a", "BIGINT", "declared", 1), ("a", "STRING", "other type", 1), ("a", "VOID", "null", 1),
        ("b", "OBJECT", "unknown", 1),
    ]
    assert payloads.field_types(rows, "payload", {}).where("status = 'unknown'").count() == 3
    assert payloads.field_types(rows.limit(0), "payload", {}).count() == 0


def test_payloads_are_read_once(spark):
    path = fresh_path(spark, "payloads")
    spark.range(10).select(F.to_json(F.struct("id")).alias("value")).write.text(path)
    plan = payloads.read_payloads(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
