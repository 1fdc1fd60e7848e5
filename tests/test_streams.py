"""Streams under failure, replay, disorder and bad input."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from heronry.operators.aggregates import add_parts, customer_metrics, metric_parts
from heronry.operators.running import running_average
from heronry.sources.topics import decode_json, publish, stream_topic
from heronry.streaming import jobs, runs
from heronry.streaming.folded import FoldedTable, newest, numbered

TX = """transaction_id bigint, customer_id bigint, transaction_date timestamp_ntz, quantity int,
    gross_amount double, discount_applied double"""
AS_OF = date(2024, 3, 1)


def tx(spark, *rows):
    return spark.createDataFrame(
        [(i, c, datetime(2024, 1, d), q, g, disc) for i, c, d, q, g, disc in rows], TX
    )


FIRST = [(1, 7, 10, 2, 100.0, 10.0), (2, 8, 5, 1, 20.0, None)]
SECOND = [(3, 7, 4, 1, 30.5, 0.25), (4, 9, 20, 3, 9.99, 0.0), (4, 9, 20, 3, 9.99, 0.0)]


def table_rows(metrics):
    return {tuple(r) for r in metrics.table(AS_OF).collect()}


def expected_rows(spark, *rows):
    return {tuple(r) for r in customer_metrics(tx(spark, *rows), AS_OF, "amount").collect()}


def test_replayed_and_out_of_order_batches(spark, tmp_path):
    metrics = jobs.CustomerMetrics(spark, str(tmp_path), "amount")
    metrics.handle(tx(spark, *FIRST), 0)
    metrics.handle(tx(spark, *SECOND), 1)
    whole = expected_rows(spark, *FIRST, *SECOND)
    assert table_rows(metrics) == whole
    for _ in range(2):
        metrics.handle(tx(spark, *SECOND), 1)
    assert table_rows(metrics) == whole
    assert metrics.raw().count() == 5
    # The later batch is older for customer 7; the clock does not go back.
    (seven,) = [r for r in metrics.table(AS_OF).collect() if r["customer_id"] == 7]
    assert seven["last_update_time"] == datetime(2024, 1, 10)


def test_empty_batch_is_skipped(spark, tmp_path):
    metrics = jobs.CustomerMetrics(spark, str(tmp_path), "amount")
    metrics.handle(tx(spark, *FIRST).where("false"), 0)
    with pytest.raises(LookupError):
        metrics.table(AS_OF)


def test_folding_keeps_totals_and_ignores_replays(spark, tmp_path):
    metrics = jobs.CustomerMetrics(spark, str(tmp_path), "amount", fold_after=2)
    rows = []
    for number in range(5):
        batch = [(number, number % 2, 1 + number, 1, 10.0 + number, 1.0)]
        rows += batch
        metrics.handle(tx(spark, *batch), number)
        metrics.handle(tx(spark, *batch), number)
        assert table_rows(metrics) == expected_rows(spark, *rows)
    metrics.handle(tx(spark, (0, 0, 1, 1, 10.0, 1.0)), 0)
    assert table_rows(metrics) == expected_rows(spark, *rows)


def test_totals_before_a_batch(spark, tmp_path):
    add = lambda parts: add_parts(parts, "customer_id")
    state = FoldedTable(spark, str(tmp_path), add, fold_after=10)
    for number in range(4):
        batch = tx(spark, (number, 1, 1 + number, 1, 10.0, 0.0))
        state.put(metric_parts(batch, "customer_id", "amount"), number)
    assert state.read(before=0) is None
    for before in (1, 2, 3, 4):
        assert state.read(before=before).first()["total_transactions"] == before
    keys = spark.createDataFrame([(1,), (5,)], "customer_id bigint")
    assert state.read(among=keys).first()["total_transactions"] == 4
    assert state.read(among=keys.where("customer_id = 5")).count() == 0


def test_failed_batch_is_done_again(spark, tmp_path):
    publish(spark.range(10), "parquet", f"{tmp_path}/topic")
    stream = decode_json(stream_topic(spark, "parquet", f"{tmp_path}/topic"), "id bigint")
    store = jobs.changes_to(f"{tmp_path}/out")

    def failing(batch, number):
        store(batch, number)
        raise RuntimeError("after the write")

    with pytest.raises(Exception, match="after the write"):
        runs.finish(runs.to_batches(stream, failing, f"{tmp_path}/progress"))
    runs.finish(runs.to_batches(stream, store, f"{tmp_path}/progress"))
    assert jobs.stored_rows(spark, f"{tmp_path}/out").count() == 10


def test_malformed_records_become_null_rows(spark, tmp_path):
    lines = ['{"sensor": "a", "v": 1.5}', "{broken", '{"sensor": "b", "v": "high"}']
    spark.createDataFrame([(bytearray(x.encode()),) for x in lines], "value binary").write.parquet(
        f"{tmp_path}/topic"
    )
    stream = decode_json(stream_topic(spark, "parquet", f"{tmp_path}/topic"), "sensor string, v double")
    runs.finish(runs.to_files(stream, f"{tmp_path}/out", f"{tmp_path}/progress"))
    rows = {tuple(r) for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()}
    assert rows == {("a", 1.5), (None, None), ("b", None)}


def test_running_average_over_batches(spark, tmp_path):
    sensor = lambda i: None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
    rows = [(i, sensor(i), i / 4) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, sensor string, v double")
    for start in (0, 100, 200):
        publish(df.where(F.col("id").between(start, start + 99)), "parquet", f"{tmp_path}/topic")
        stream = decode_json(
            stream_topic(spark, "parquet", f"{tmp_path}/topic"), "id bigint, sensor string, v double"
        )
        runs.finish(
            jobs.running_average(
                stream, str(tmp_path), f"{tmp_path}/progress", "sensor", ["id"], "v"
            )
        )
    got = {r["id"]: r["running_avg"] for r in jobs.stored_rows(spark, f"{tmp_path}/out").collect()}
    batch = running_average(df, "sensor", ["id"], "v").collect()
    assert got == {r["id"]: r["running_avg"] for r in batch}


def test_updates_of_running_sums(spark, tmp_path):
    deliveries = [[(1, 1500.0), (2, 10.0)], [(1, 600.0), (2, 5.0)], [(1, -1000.0)]]
    seen = []
    for rows in deliveries:
        part = spark.createDataFrame(rows, "user_id bigint, amount double")
        publish(part, "parquet", f"{tmp_path}/topic")
        stream = decode_json(
            stream_topic(spark, "parquet", f"{tmp_path}/topic"), "user_id bigint, amount double"
        )
        sums = jobs.sums_by_key(stream, "user_id", "amount", "spent")
        table = FoldedTable(spark, f"{tmp_path}/out", newest("user_id", "spent"))
        runs.finish(runs.to_batches(sums, numbered(table), f"{tmp_path}/progress", "update"))
        above = table.read().where("spent > 2000").collect()
        seen.append({(r["user_id"], r["spent"]) for r in above})
    # A refund takes the user out again.
    assert seen == [set(), {(1, 2100.0)}, set()]


def test_listed_folders_are_bounded(spark, tmp_path):
    add = lambda parts: add_parts(parts, "customer_id")
    state = FoldedTable(spark, str(tmp_path), add, fold_after=3)
    for number in range(20):
        batch = tx(spark, (number, 1, 1, 1, 10.0, 0.0))
        state.put(metric_parts(batch, "customer_id", "amount"), number)
        listed = [*tmp_path.glob("*/batch_id=*")]
        assert len(listed) <= 2 * 3 + 3
    state.put(metric_parts(batch, "customer_id", "amount"), 19)
    assert state.read().first()["total_transactions"] == 20
    assert state.read(before=19).first()["total_transactions"] == 19


def test_console_shows_only_the_first_rows(spark, tmp_path):
    publish(spark.range(100), "parquet", f"{tmp_path}/topic")
    stream = decode_json(stream_topic(spark, "parquet", f"{tmp_path}/topic"), "id bigint")
    shown = []
    runs.finish(runs.to_console(stream, f"{tmp_path}/progress", rows=3, emit=shown.append))
    assert len(shown) == 1 and len(shown[0].splitlines()) == 4


def test_stamp(spark, tmp_path):
    publish(spark.range(5), "parquet", f"{tmp_path}/topic")
    stream = runs.stamped(decode_json(stream_topic(spark, "parquet", f"{tmp_path}/topic"), "id bigint"))
    runs.finish(runs.to_files(stream, f"{tmp_path}/out", f"{tmp_path}/progress"))
    stamps = spark.read.parquet(f"{tmp_path}/out").select("processing_time").distinct().collect()
    assert len(stamps) == 1 and stamps[0][0] is not None
