"""Streaming jobs over topics and landing folders that Spark fills from the given tables.

Each query runs its streams until everything that has landed is processed and gives the settled
result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.operators import filters, joins, projections
from heronry.plans import sql
from heronry.plans.registry import plain, query
from heronry.plans.running import ORDER, RUNNING_AVG
from heronry.plans.sales import ENRICHED_SQL, order_rules
from heronry.plans.views import (
    AS_OF,
    clicks,
    purchases,
    raw_customers,
    raw_orders,
    readings,
    table,
    transactions,
)
from heronry.session import fresh_path
from heronry.sinks.files import append_rows
from heronry.sources.positions import stream_numbered
from heronry.sources.topics import decode_json, publish, read_topic, stream_topic
from heronry.streaming import crossing, jobs, runs
from heronry.streaming.folded import FoldedTable, newest, numbered

READING = "event_id bigint, sensor_id bigint, value double, ts timestamp_ntz"
PURCHASE = "event_id bigint, user_id bigint, product_id string, amount double, ts timestamp_ntz"
CLICK = "user_id string, page string, action string, timestamp string, duration double, device string"
TRANSACTION = """transaction_id bigint, customer_id bigint, product_id bigint,
    transaction_date timestamp_ntz, quantity int, gross_amount double, discount_applied double,
    payment_method string"""

READINGS_SQL = "SELECT event_id, user_id AS sensor_id, value, ts FROM events"


class Topic:
    """A topic of JSON files in the shared folder, with room for checkpoints and results."""

    def __init__(self, spark: SparkSession, label: str, *slices: DataFrame):
        self.spark, self.root = spark, fresh_path(spark, label)
        for rows in slices:
            self.add(rows)

    def add(self, rows: DataFrame) -> None:
        publish(rows, "parquet", f"{self.root}/topic")

    def stream(self, schema: str, **options: str) -> DataFrame:
        return decode_json(stream_topic(self.spark, "parquet", f"{self.root}/topic", **options), schema)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def result(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))


def in_time_slices(df: DataFrame) -> list[DataFrame]:
    """The whole table as three deliveries in time order."""
    first, second = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-11", "2024-01-21"))
    late = F.coalesce(F.col("ts") >= second, F.lit(True))
    return [
        df.where(F.col("ts") < first),
        df.where((F.col("ts") >= first) & (F.col("ts") < second)),
        df.where(late),
    ]


# --- sources ----------------------------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    topic = Topic(spark, label, readings(spark, sf_dir))
    stream = topic.stream(READING)
    runs.finish(runs.to_files(stream, topic.path("out"), topic.path("progress")))
    return topic.result("out", stream.schema)


@query("st_src_kafka_json", READINGS_SQL)
def parsed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "st-src-topic")


@query("st_parse_append", READINGS_SQL)
def parse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "st-parse")


@query("src_kafka_batch_json", READINGS_SQL)
def bounded_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "src-topic", readings(spark, sf_dir))
    return decode_json(read_topic(spark, "parquet", topic.path("topic")), READING)


@query("st_src_files_parquet", "SELECT * FROM orders")
def new_parquet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "st-files-parquet")
    orders = table(spark, sf_dir, "orders")
    orders.write.parquet(f"{root}/landed")
    stream = spark.readStream.schema(orders.schema).parquet(f"{root}/landed")
    runs.finish(runs.to_files(stream, f"{root}/out", f"{root}/progress"))
    return spark.read.schema(orders.schema).parquet(f"{root}/out")


@query("st_src_files_json", "SELECT * FROM customer")
def new_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "st-files-json")
    customer = table(spark, sf_dir, "customer")
    customer.write.json(f"{root}/landed")
    stream = spark.readStream.schema(customer.schema).json(f"{root}/landed")
    runs.finish(runs.to_files(stream, f"{root}/out", f"{root}/progress"))
    return spark.read.schema(customer.schema).parquet(f"{root}/out")


@query(
    "st_ingest_bronze",
    """SELECT 'customers_raw' AS table_name, COUNT(*) AS row_count,
    CAST(SUM(c_custkey) AS BIGINT) AS key_sum FROM customer
    UNION ALL SELECT 'orders_raw', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders""",
)
def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    def summary(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.sum(key).alias("key_sum"),
        )

    return summary("customers_raw", new_json_files(spark, sf_dir), "c_custkey").unionByName(
        summary("orders_raw", new_parquet_files(spark, sf_dir), "o_orderkey")
    )


SLICED = """SELECT event_id, value, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0
    WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS {batch} FROM events"""


@query("st_src_offsets", SLICED.format(batch="batch_id"))
def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, one run after each: the first run starts at the earliest record, every other one
    where the last one ended. Starting at the latest record is an option of the topic reader
    (``kafka_options``); it needs a broker, which is not here, so only the option itself is tested."""
    topic = Topic(spark, "st-offsets")
    for rows in in_time_slices(readings(spark, sf_dir)):
        topic.add(rows)
        stored = jobs.changes_to(topic.path("out"))
        runs.finish(runs.to_batches(topic.stream(READING), stored, topic.path("progress")))
    return jobs.stored_rows(spark, topic.path("out")).select("event_id", "value", "batch_id")


THIRD = "(SELECT MAX(event_id) // 3 FROM events)"


@query(
    "st_src_positions",
    f"""SELECT 'earliest' AS start, event_id, value FROM events
    UNION ALL SELECT 'latest', event_id, value FROM events WHERE event_id > {THIRD}
    UNION ALL SELECT 'given', event_id, value FROM events WHERE event_id > {THIRD} // 2""",
)
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams over one growing table: all of it, what comes after the start, and what is behind a given
    number. They run while the second delivery lands, are stopped, and go on after the third."""
    root = fresh_path(spark, "st-positions")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    third = events.agg(F.max("event_id")).first()[0] // 3
    starts = {"earliest": "earliest", "latest": "latest", "given": third // 2}

    def land(low: int, high: int | None) -> None:
        rows = events.where(F.col("event_id") > low)
        rows = rows if high is None else rows.where(F.col("event_id") <= high)
        append_rows(rows, f"{root}/landed")

    def start(name: str):
        stream = stream_numbered(spark, f"{root}/landed", events.schema, "event_id", starts[name])
        return runs.to_files(stream, f"{root}/{name}", f"{root}/{name}-progress", runs.every("0 seconds"))

    land(-1, third)
    running = [start(name) for name in starts]
    for run in running:
        run.processAllAvailable()
    land(third, 2 * third)
    for run in running:
        run.processAllAvailable()
        run.stop()
    land(2 * third, None)
    for run in [start(name) for name in starts]:
        run.processAllAvailable()
        run.stop()
    shown = [
        spark.read.schema(events.schema).parquet(f"{root}/{n}").select(F.lit(n).alias("start"), "event_id", "value")
        for n in starts
    ]
    return shown[0].unionAll(shown[1]).unionAll(shown[2])


@query("st_checkpoint", READINGS_SQL)
def resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped and started again over the same topic: nothing is lost or repeated."""
    topic = Topic(spark, "st-checkpoint")
    stream = None
    for rows in in_time_slices(readings(spark, sf_dir)):
        topic.add(rows)
        for _ in range(2):
            stream = topic.stream(READING)
            runs.finish(runs.to_files(stream, topic.path("out"), topic.path("progress")))
    return topic.result("out", stream.schema)


@query(
    "st_rate_limit",
    "SELECT COUNT(*) AS row_count, TRUE AS within_limit, TRUE AS several_batches FROM events",
)
def rate_limited(spark: SparkSession, sf_dir: str, files_per_batch: int = 2) -> DataFrame:
    """Three deliveries, of which a batch may take only so many files. On a large topic choose the limit
    by what a batch can process, not one file a batch."""
    topic = Topic(spark, "st-rate", *in_time_slices(readings(spark, sf_dir)))
    stream = stream_topic(
        spark, "parquet", topic.path("topic"), maxFilesPerTrigger=str(files_per_batch)
    )
    named = decode_json_with_file(stream)
    runs.finish(
        runs.to_batches(named, jobs.changes_to(topic.path("out")), topic.path("progress"))
    )
    per_batch = (
        jobs.stored_rows(spark, topic.path("out"))
        .groupBy("batch_id", "file")
        .agg(F.count("*").alias("row_count"))
        .groupBy("batch_id")
        .agg(F.count("*").alias("files"), F.sum("row_count").alias("row_count"))
    )
    return per_batch.agg(
        F.sum("row_count").alias("row_count"),
        (F.max("files") <= files_per_batch).alias("within_limit"),
        (F.count("*") > 1).alias("several_batches"),
    )


def decode_json_with_file(topic: DataFrame) -> DataFrame:
    parsed = F.from_json(F.col("value").cast("string"), READING)
    return topic.select(parsed["event_id"].alias("event_id"), F.input_file_name().alias("file"))


@query("st_trigger_interval", READINGS_SQL)
def on_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "st-interval", readings(spark, sf_dir))
    stream = topic.stream(READING)
    running = runs.to_files(stream, topic.path("out"), topic.path("progress"), runs.every("1 second"))
    running.processAllAvailable()
    running.stop()
    return topic.result("out", stream.schema)


# --- running results --------------------------------------------------------------------------


@query("st_running_avg", RUNNING_AVG)
def sensor_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "st-running-avg")
    for rows in in_time_slices(readings(spark, sf_dir)):
        topic.add(rows)
        runs.finish(
            jobs.running_average(
                topic.stream(READING), topic.root, topic.path("progress"), "sensor_id", ORDER, "value"
            )
        )
    return jobs.stored_rows(spark, topic.path("out")).select(
        "event_id", "sensor_id", "value", "running_avg"
    )


REVENUE_SQL = f"SELECT event_type AS product_id, {sql.exact('value')} AS revenue FROM events GROUP BY 1"
SPENDING_SQL = f"""SELECT user_id, {sql.exact('value')} AS spending FROM events GROUP BY 1
    HAVING SUM(CAST(value AS DECIMAL(12,2))) > 2000"""


def _updated(topic: Topic, sums: DataFrame, label: str, key: str, value: str) -> DataFrame:
    """Run a query in update mode and keep the newest row of each key."""
    table = FoldedTable(topic.spark, topic.path(label), newest(key, value))
    progress = topic.path(f"{label}-progress")
    runs.finish(runs.to_batches(sums, numbered(table), progress, "update"))
    return table.read().select(key, value)


def _revenue(topic: Topic) -> DataFrame:
    sums = jobs.sums_by_key(topic.stream(PURCHASE), "product_id", "amount", "revenue")
    return _updated(topic, sums, "revenue", "product_id", "revenue")


def _spending(topic: Topic) -> DataFrame:
    sums = jobs.sums_by_key(topic.stream(PURCHASE), "user_id", "amount", "spending")
    return filters.above(_updated(topic, sums, "spending", "user_id", "spending"), "spending", 2000)


@query("st_sum_by_product", REVENUE_SQL)
def revenue_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "st-revenue")
    for rows in in_time_slices(purchases(spark, sf_dir)):
        topic.add(rows)
        settled = _revenue(topic)
    return settled


@query("st_high_value_users", SPENDING_SQL)
def spending_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "st-spending")
    for rows in in_time_slices(purchases(spark, sf_dir)):
        topic.add(rows)
        settled = _spending(topic)
    return settled


DELIVERED = f"""slice AS (SELECT {{key}} AS key, batch_id, SUM(CAST(value AS DECIMAL(12,2))) AS own
      FROM ({SLICED.format(batch="batch_id").replace("event_id, value", "event_type, user_id, value")}) GROUP BY 1, 2),
    total AS (SELECT key, batch_id, SUM(own) OVER (PARTITION BY key ORDER BY batch_id) AS now, own FROM slice)"""


def _emitted(spark: SparkSession, sf_dir: str, label: str, make) -> DataFrame:
    """What leaves the batches of three deliveries, with a restart before each."""
    topic = Topic(spark, label)
    for rows in in_time_slices(purchases(spark, sf_dir)):
        topic.add(rows)
        stored = jobs.changes_to(topic.path("out"))
        runs.finish(runs.to_batches(make(topic.stream(PURCHASE)), stored, topic.path("progress"), "update"))
    return jobs.stored_rows(spark, topic.path("out"))


@query(
    "st_changed_totals",
    f"""WITH {DELIVERED.format(key="event_type")}
    SELECT key AS product_id, batch_id, CAST(now AS DOUBLE) AS revenue FROM total""",
)
def changed_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch hands on the totals that it changed."""
    changed = _emitted(
        spark, sf_dir, "st-changed", lambda s: crossing.changed_totals(s, "product_id", "amount")
    )
    return changed.select("product_id", "batch_id", F.col("total").alias("revenue"))


@query(
    "st_crossings",
    f"""WITH {DELIVERED.format(key="user_id")}
    SELECT key AS user_id, batch_id, CAST(now AS DOUBLE) AS spending, now > 700 AS above FROM total
    WHERE (now > 700) <> (now - own > 700)""",
)
def spending_crossed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only users whose spending has crossed the bound leave a batch."""
    crossed = _emitted(
        spark, sf_dir, "st-crossings", lambda s: crossing.crossings(s, "user_id", "amount", 700.0)
    )
    return crossed.select("user_id", "batch_id", F.col("total").alias("spending"), "above")


@query(
    "st_independent_readers",
    f"""SELECT 'product' AS reader, product_id AS key, revenue AS total FROM ({REVENUE_SQL})
    UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), spending FROM ({SPENDING_SQL})""",
)
def two_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries with a checkpoint each: both see the whole topic."""
    topic = Topic(spark, "st-readers", purchases(spark, sf_dir))
    shape = lambda df, reader, key, total: df.select(
        F.lit(reader).alias("reader"), F.col(key).cast("string").alias("key"), F.col(total).alias("total")
    )
    return shape(_revenue(topic), "product", "product_id", "revenue").unionByName(
        shape(_spending(topic), "user", "user_id", "spending")
    )


@query(
    "st_output_modes",
    f"""SELECT 'append' AS mode, event_type AS product_id, {sql.exact('value')} AS amount FROM events GROUP BY 2
    UNION ALL SELECT 'update', event_type, {sql.exact('value')} FROM events GROUP BY 2""",
)
def output_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended and summed afterwards, beside sums updated by the stream."""
    topic = Topic(spark, "st-modes", purchases(spark, sf_dir))
    stream = topic.stream(PURCHASE)
    runs.finish(runs.to_files(stream, topic.path("rows"), topic.path("rows-progress")))
    appended = jobs.sums_by_key(topic.result("rows", stream.schema), "product_id", "amount", "amount")
    updated = _revenue(topic).withColumnRenamed("revenue", "amount")
    columns = ["product_id", "amount"]
    return appended.select(F.lit("append").alias("mode"), *columns).unionByName(
        updated.select(F.lit("update").alias("mode"), *columns)
    )


# --- sinks ------------------------------------------------------------------------------------


@query(
    "st_sink_console",
    "SELECT COUNT(*) AS row_count, least(COUNT(*), 20) AS shown, TRUE AS as_sent FROM events",
)
def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the console printed for the one batch of the topic: its first rows, each of which is compared
    with the readings. A second reader counts all rows."""
    topic = Topic(spark, "st-console", readings(spark, sf_dir))
    stream = topic.stream(READING)
    printed: list[str] = []
    runs.finish(runs.to_console(stream, topic.path("shown-progress"), emit=printed.append))
    lines = [(line,) for text in printed for line in text.splitlines()[1:]]
    runs.finish(runs.to_files(stream, topic.path("out"), topic.path("progress")))
    rows = topic.result("out", stream.schema)
    # At most 20 lines of the console.
    ids = spark.createDataFrame(lines, "line string").select(
        F.regexp_extract("line", "'event_id': ([0-9]+)", 1).cast("bigint").alias("event_id"),
        F.regexp_extract("line", "'value': ([-0-9.e]+)", 1).cast("double").alias("value"),
    )
    found = rows.join(F.broadcast(ids), ["event_id", "value"], "left_semi")
    return rows.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(lines)).cast("bigint").alias("shown"),
        F.lit(found.count() == len(lines)).alias("as_sent"),
    )


@query("st_sink_topic", READINGS_SQL)
def to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "st-sink-topic", readings(spark, sf_dir))
    out = topic.path("out")
    runs.finish(runs.to_topic(topic.stream(READING), topic.path("progress"), "parquet", path=out))
    return decode_json(read_topic(spark, "parquet", out), READING)


@query(
    "st_click_reshape",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, '/page/' || json_extract_string(props, '$.k') AS page,
    event_type AS action, 1 AS "count", value AS total_duration, ts AS processing_time,
    CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 50 THEN 'mobile' ELSE 'desktop' END
    AS device FROM events""",
)
def click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic(spark, "st-clicks", clicks(spark, sf_dir))
    activity = projections.reshape_click(topic.stream(CLICK)).withColumn(
        "processing_time", F.to_timestamp("processing_time")
    )
    runs.finish(runs.to_files(activity, topic.path("out"), topic.path("progress")))
    return plain(topic.result("out", activity.schema))


# --- joins and merges -------------------------------------------------------------------------


@query("st_join_enrich", ENRICHED_SQL)
def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "st-enrich")
    orders = raw_orders(spark, sf_dir)
    orders.write.parquet(f"{root}/landed")
    stream = spark.readStream.schema(orders.schema).parquet(f"{root}/landed")
    cleaned = filters.meets(stream, order_rules())
    customers = raw_customers(spark, sf_dir)
    runs.finish(jobs.enriched(cleaned, customers, root, f"{root}/progress"))
    return jobs.stored_rows(spark, f"{root}/out").drop("batch_id")


def _metrics_stream(spark: SparkSession, sf_dir: str, label: str) -> jobs.CustomerMetrics:
    """All transactions, delivered in two parts by date, through the metrics stream."""
    topic = Topic(spark, label)
    metrics = jobs.CustomerMetrics(spark, topic.root, "amount")
    rows = transactions(spark, sf_dir, "amount")
    date = F.col("transaction_date")
    early = F.coalesce(date < F.lit("1999-01-01").cast("timestamp_ntz"), F.lit(False))
    for part in (early, ~early):
        topic.add(rows.where(part))
        runs.finish(metrics.start(topic.stream(TRANSACTION), topic.path("progress"), runs.AVAILABLE))
    return metrics


@query(
    "st_foreach_batch_multi",
    f"""WITH {sql.TRANSACTIONS} SELECT transaction_id, customer_id, product_id, transaction_date,
    quantity, gross_amount, CAST(round(gross * rate, 2) AS DOUBLE) AS discount_applied,
    payment_method FROM tx""",
)
def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _metrics_stream(spark, sf_dir, "st-foreach-batch").raw()
    return raw.drop("batch_id", "processing_time")


@query("st_customer_metrics_merge", f"WITH {sql.METRICS_AMOUNT} SELECT * FROM metrics")
def merged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_stream(spark, sf_dir, "st-metrics").table(AS_OF)
