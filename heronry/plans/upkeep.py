"""Datasets that change: versions of a schema, partitions, buckets, counted writes, clusters, table graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from heronry.functions.numbers import exact_sum
from heronry.operators import clustering, evolution
from heronry.operators.evolution import field
from heronry.plans import sql
from heronry.plans.registry import query
from heronry.plans.sales import RAW_ORDERS, order_rules
from heronry.plans.storage import COUNTERS, MERGED_SQL, RECENCY, two_periods
from heronry.plans.views import raw_orders, table
from heronry.session import fresh_path
from heronry.sinks import bucketed, counted, partitions, versions
from heronry.sinks.graph import TableGraph
from heronry.sources import payloads as sources
from heronry.streaming import runs

# --- versions of a schema ---------------------------------------------------------------------

# Types as objects: parsing their names would need a session when this module is imported.
INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# Customers as five versions of a service wrote them.
VERSIONS = [
    T.StructType([field("id", INT, required=True), field("name", TEXT), field("email", TEXT)]),
    T.StructType(
        [
            field("id", LONG, required=True),
            field("name", TEXT),
            field("email", TEXT),
            field("age", INT, default=-1),
        ]
    ),
    T.StructType(
        [
            field("id", LONG, required=True),
            field("full_name", TEXT, "name"),
            field("email", TEXT, default=""),
            field("age", DOUBLE, default=-1),
        ]
    ),
    T.StructType(
        [
            field("id", LONG, required=True),
            field("full_name", TEXT, "name"),
            field("age", DOUBLE, default=-1),
            field("segment", TEXT, default="none"),
        ]
    ),
    T.StructType(
        [
            field("id", TEXT, required=True),
            field("full_name", TEXT, "name"),
            field("age", DOUBLE, default=-1),
        ]
    ),
]

PERSONS = """person AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
    coalesce(c_nationkey, 0) % 5 + 1 AS version,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS email FROM customer)"""


def customer_versions(spark: SparkSession, sf_dir: str) -> str:
    """A dataset to which each version appended its own customers, by nation."""
    root = fresh_path(spark, "customer-versions")
    customer = table(spark, sf_dir, "customer")
    values = {
        "id": F.col("c_custkey"),
        "name": F.col("c_name"),
        "full_name": F.col("c_name"),
        "email": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        "age": F.col("c_acctbal"),
        "segment": F.col("c_mktsegment"),
    }
    for number, schema in enumerate(VERSIONS):
        own = customer.where(F.coalesce("c_nationkey", F.lit(0)) % 5 == number)
        rows = own.select(*[values[f.name].alias(f.name) for f in schema])
        versions.next_version(evolution.declared(rows, schema), root)
    return root


@query(
    "sch_compatibility",
    f"""WITH {PERSONS}, size AS (SELECT version, COUNT(*) AS n FROM person GROUP BY version),
    verdict(older, newer, backward, forward) AS (VALUES
      (1, 2, TRUE, FALSE), (1, 3, TRUE, FALSE), (2, 3, TRUE, FALSE), (1, 4, TRUE, FALSE), (2, 4, TRUE, FALSE),
      (3, 4, TRUE, TRUE), (1, 5, FALSE, FALSE), (2, 5, FALSE, FALSE), (3, 5, FALSE, FALSE), (4, 5, FALSE, FALSE)),
    rules AS (
      SELECT older, newer, 'BACKWARD' AS rule, backward AS compatible FROM verdict
      UNION ALL SELECT older, newer, 'FORWARD', forward FROM verdict
      UNION ALL SELECT older, newer, 'FULL', backward AND forward FROM verdict
      UNION ALL SELECT 1, newer, 'BACKWARD_TRANSITIVE', bool_and(backward) FROM verdict GROUP BY newer
      UNION ALL SELECT 1, newer, 'FORWARD_TRANSITIVE', bool_and(forward) FROM verdict GROUP BY newer
      UNION ALL SELECT 1, newer, 'FULL_TRANSITIVE', bool_and(backward AND forward) FROM verdict GROUP BY newer)
    SELECT CAST(older AS BIGINT) AS older, CAST(newer AS BIGINT) AS newer, rule, compatible,
      coalesce(o.n, 0) AS older_rows, coalesce(p.n, 0) AS newer_rows
    FROM rules LEFT JOIN size o ON o.version = older LEFT JOIN size p ON p.version = newer""",
)
def compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each pair of stored versions and rule; the transitive ones hold a version against all before."""
    root = customer_versions(spark, sf_dir)
    known = evolution.version_schemas(spark, root)
    verdicts = []
    for newer in known:
        earlier = [v for v in known if v < newer]
        for rule in evolution.RULES:
            for older in earlier:
                fine = not evolution.violations(known[newer], [known[older]], rule)
                verdicts.append((older, newer, rule, fine))
            if earlier:
                transitive = rule + evolution.TRANSITIVE
                fine = not evolution.violations(known[newer], [known[v] for v in earlier], transitive)
                verdicts.append((earlier[0], newer, transitive, fine))
    pairs = spark.createDataFrame(verdicts, "older long, newer long, rule string, compatible boolean")
    rows = versions.history(spark, root)
    older = rows.select(F.col("version").alias("older"), F.col("row_count").alias("older_rows"))
    newer = rows.select(F.col("version").alias("newer"), F.col("row_count").alias("newer_rows"))
    return pairs.join(older, "older", "left").join(newer, "newer", "left").fillna(0)


@query(
    "sch_resolved_read",
    f"""WITH {PERSONS} SELECT c_custkey AS id, c_name AS full_name,
    CASE version WHEN 1 THEN -1.0 WHEN 2 THEN CAST(CAST(trunc(c_acctbal) AS INTEGER) AS DOUBLE)
      ELSE c_acctbal END AS age,
    CASE WHEN version = 4 THEN c_mktsegment ELSE 'none' END AS segment FROM person WHERE version < 5""",
)
def read_as_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four versions that the fourth can read, with its names, types and defaults."""
    return evolution.read_resolved(spark, customer_versions(spark, sf_dir), VERSIONS[3], [1, 2, 3, 4])


@query(
    "sch_absent_fields",
    f"""WITH {PERSONS}, present(version, field, absent) AS (VALUES
      (1, 'full_name', FALSE), (1, 'email', FALSE), (1, 'age', TRUE),
      (2, 'full_name', FALSE), (2, 'email', FALSE), (2, 'age', FALSE),
      (3, 'full_name', FALSE), (3, 'email', FALSE), (3, 'age', FALSE),
      (4, 'full_name', FALSE), (4, 'email', TRUE), (4, 'age', FALSE),
      (5, 'full_name', FALSE), (5, 'email', TRUE), (5, 'age', FALSE)),
    counted AS (SELECT version, COUNT(*) AS n, COUNT(*) FILTER (WHERE c_name IS NULL) AS full_name,
      COUNT(*) FILTER (WHERE email IS NULL) AS email, COUNT(*) FILTER (WHERE c_acctbal IS NULL) AS age
      FROM person GROUP BY version)
    SELECT CAST(p.version AS BIGINT) AS version, p.field, coalesce(n, 0) AS row_count,
      CASE WHEN absent THEN 0 ELSE coalesce(CASE p.field WHEN 'full_name' THEN full_name
        WHEN 'email' THEN email ELSE age END, 0) END AS null_count,
      CASE WHEN absent THEN coalesce(n, 0) ELSE 0 END AS absent_count
    FROM present p LEFT JOIN counted c ON c.version = p.version""",
)
def fields_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null is told from a field that the version did not have."""
    wanted = T.StructType(
        [field("full_name", TEXT, "name"), field("email", TEXT), field("age", DOUBLE)]
    )
    return evolution.absent_fields(spark, customer_versions(spark, sf_dir), wanted)


# --- partitions that change -------------------------------------------------------------------

MONTHLY = "monthly AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders)"


def monthly_orders(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """Orders partitioned by month: the folder and the schema."""
    path = fresh_path(spark, "orders-by-month")
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    partitions.overwrite_partitions(orders, path, "month", "o_orderkey")
    return path, orders.schema


@query(
    "update_where_partitions",
    f"""WITH {MONTHLY} SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN month = '1996-03' AND o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority, month FROM monthly""",
)
def month_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update that holds in one month writes that month's folder only."""
    path, schema = monthly_orders(spark, sf_dir)
    condition = (F.col("month") == "1996-03") & (F.col("o_orderstatus") == "F")
    partitions.update_partitions(
        spark, path, schema, "month", "o_orderkey", "o_totalprice", F.lit(0.0), condition
    )
    return spark.read.schema(schema).parquet(path)


@query(
    "keyed_changes_partitions",
    f"""WITH {MONTHLY} SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN month = '1996-02' AND o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority, month FROM monthly WHERE month IS DISTINCT FROM '1996-01'
    UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, month
    FROM monthly WHERE month = '1996-03'""",
)
def months_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes that empty a month, updates in the next and inserts in the one after."""
    path, schema = monthly_orders(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))

    def change(month: str, action: str) -> DataFrame:
        return orders.where(F.col("month") == month).withColumns({"action": F.lit(action), "step": F.lit(1)})

    deleted = change("1996-01", "delete")
    updated = change("1996-02", "update").where("o_orderstatus = 'P'")
    updated = updated.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    inserted = change("1996-03", "insert").withColumn("o_orderkey", F.lit(-1) - F.col("o_orderkey"))
    changes = deleted.unionByName(updated).unionByName(inserted)
    partitions.merge_partitions(spark, path, schema, "month", "o_orderkey", changes, "o_orderkey", ["step"])
    return spark.read.schema(schema).parquet(path)


# --- buckets ----------------------------------------------------------------------------------


@query("keyed_merge_bucketed", MERGED_SQL)
def merged_in_buckets(spark: SparkSession, sf_dir: str, buckets: int = 16) -> DataFrame:
    """Customer metrics kept in a bucketed table, and the metrics of a batch merged into it."""
    older, newer = two_periods(spark, sf_dir)
    stored, merged = (f"metrics_{uuid.uuid4().hex}" for _ in range(2))
    bucketed.save_bucketed(older, stored, "customer_id", buckets, fresh_path(spark, "metrics"))
    try:
        bucketed.merge_bucketed(
            spark, stored, merged, newer, "customer_id", COUNTERS, RECENCY, "last_update_time", buckets,
            fresh_path(spark, "metrics"), keep_unknown=True,
        )
        rows = spark.table(merged)
        rows.schema  # resolved before the names go; the files are external and stay
        return rows
    finally:
        for name in (stored, merged):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- counts from the write itself -------------------------------------------------------------


def _as_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "name string, n long")


@query(
    "flt_quality_counts",
    f"""WITH {RAW_ORDERS} SELECT 'row_count' AS name, COUNT(*) AS n FROM raw_orders
    UNION ALL SELECT 'kept', COUNT(*) FROM raw_orders WHERE order_id IS NOT NULL AND quantity > 0
    UNION ALL SELECT 'failed_order_id', COUNT(*) FROM raw_orders WHERE order_id IS NULL
    UNION ALL SELECT 'failed_quantity', COUNT(*) FROM raw_orders WHERE quantity IS NULL OR quantity <= 0
    UNION ALL SELECT 'stored', COUNT(*) FROM raw_orders WHERE order_id IS NOT NULL AND quantity > 0""",
)
def counted_while_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that meet the rules are stored; the same job counts what each rule let go."""
    path = fresh_path(spark, "orders-cleaned")
    counts = counted.write_meeting(raw_orders(spark, sf_dir), path, order_rules())
    return _as_rows(spark, counts | {"stored": spark.read.parquet(path).count()})


@query(
    "st_ingest_counts",
    """SELECT 'row_count' AS name, COUNT(*) AS n FROM lineitem
    UNION ALL SELECT 'kept', COUNT(*) FROM lineitem WHERE l_tax > 0 AND l_quantity > 3
    UNION ALL SELECT 'failed_taxed', COUNT(*) FROM lineitem WHERE l_tax IS NULL OR l_tax <= 0
    UNION ALL SELECT 'failed_quantity', COUNT(*) FROM lineitem WHERE l_quantity IS NULL OR l_quantity <= 3
    UNION ALL SELECT 'stored', COUNT(*) FROM lineitem WHERE l_tax > 0 AND l_quantity > 3""",
)
def counted_while_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines ingested from files as they land, several batches; each reports what its rules let go."""
    root = fresh_path(spark, "st-ingest-counts")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    lines.repartition(4).write.parquet(f"{root}/landed")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landed")
    rules = {"taxed": F.col("l_tax") > 0, "quantity": F.col("l_quantity") > 3}
    kept = counted.counting(stream, "rules", rules)
    done = runs.finish(runs.to_files(kept, f"{root}/out", f"{root}/progress"))
    total: dict[str, int] = {}
    for batch in counted.reported(done, "rules"):
        total = {k: total.get(k, 0) + n for k, n in batch.items()}
    stored = spark.read.schema(lines.schema).parquet(f"{root}/out").count()
    return _as_rows(spark, total | {"stored": stored})


# --- clusters ---------------------------------------------------------------------------------

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def clustered_lines(spark: SparkSession, sf_dir: str, files: int | None = None, **options) -> DataFrame:
    """Order lines clustered by product and store at once."""
    path = fresh_path(spark, "clustered-lines")
    lines = table(spark, sf_dir, "lineitem").select(*LINE)
    width = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    clustering.write_clustered(lines, path, ["l_partkey", "l_suppkey"], width, **options)
    return spark.read.schema(lines.schema).parquet(path)


@query(
    "flt_point_lookup_clustered",
    f"""SELECT 'product' AS found_by, {', '.join(LINE)} FROM lineitem WHERE l_partkey = 42
    UNION ALL SELECT 'store', {', '.join(LINE)} FROM lineitem WHERE l_suppkey = 7""",
)
def points_of_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = clustered_lines(spark, sf_dir)
    product = stored.where("l_partkey = 42").select(F.lit("product").alias("found_by"), *LINE)
    return product.unionAll(stored.where("l_suppkey = 7").select(F.lit("store").alias("found_by"), *LINE))


@query(
    "flt_range_lookup_clustered",
    f"""SELECT 'product' AS found_by, {', '.join(LINE)} FROM lineitem WHERE l_partkey BETWEEN 20 AND 40
    UNION ALL SELECT 'store', {', '.join(LINE)} FROM lineitem WHERE l_suppkey BETWEEN 3 AND 4""",
)
def ranges_of_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = clustered_lines(spark, sf_dir)
    product = stored.where("l_partkey BETWEEN 20 AND 40").select(F.lit("product").alias("found_by"), *LINE)
    store = stored.where("l_suppkey BETWEEN 3 AND 4").select(F.lit("store").alias("found_by"), *LINE)
    return product.unionAll(store)


# --- a graph of tables ------------------------------------------------------------------------


def order_graph(spark: SparkSession, root: str, sources: dict[str, str]) -> TableGraph:
    """Orders with their customers and cleaned lines, and revenue by segment."""
    graph = TableGraph(spark, root, sources)
    graph.declare(
        "revenue",
        lambda enriched: enriched.groupBy("segment").agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("lines").alias("lines"),
            exact_sum(F.col("price")).alias("revenue"),
        ),
        "enriched",
    )
    graph.declare(
        "enriched",
        lambda orders, customers, totals: orders.join(totals, "order_id").join(customers, "customer_id", "left"),
        "orders_raw", "customers_raw", "line_totals",
    )
    graph.declare(
        "line_totals",
        # Summed by order first, so the join moves one row an order.
        lambda lines: lines.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("lines"), exact_sum(F.col("price")).alias("price")
        ),
        "lines_cleaned",
    )
    graph.declare(
        "lines_cleaned",
        lambda lines: lines.where("l_tax > 0 AND l_quantity > 3").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("price")
        ),
        "lineitem",
    )
    graph.declare(
        "orders_raw",
        lambda orders: orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")),
        "orders",
    )
    graph.declare(
        "customers_raw",
        lambda customer: customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
        ),
        "customer",
    )
    return graph


@query(
    "pipeline_dag",
    f"""WITH total AS (SELECT l_orderkey, COUNT(*) AS lines, {sql.exact('l_extendedprice')} AS price
      FROM lineitem WHERE l_tax > 0 AND l_quantity > 3 GROUP BY l_orderkey)
    SELECT c_mktsegment AS segment, COUNT(*) AS orders, CAST(SUM(lines) AS BIGINT) AS lines,
      {sql.exact('price')} AS revenue
    FROM orders JOIN total ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1""",
)
def table_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables declared in any order with their inputs, built in the order that these give."""
    sources = {n: f"{sf_dir}/{n}.parquet" for n in ("orders", "customer", "lineitem")}
    return order_graph(spark, fresh_path(spark, "order-graph"), sources).read("revenue")


# --- payloads nobody has declared -------------------------------------------------------------

# The services that send events do not agree: ids as text, fields of their own, amounts that are null, cut records.
SENT = """sent AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    event_type = 'error' AND event_id % 2 = 0 AS cut FROM events)"""
SENT_FIELDS = {"id": "BIGINT", "props": "OBJECT", "amount": "DECIMAL"}


def landed_payloads(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "payloads")
    kind = F.col("event_type")
    head = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"))
    props = F.concat(F.lit(', "props": '), F.col("props"))
    text = (
        F.when(kind == "signup", F.concat(head, props, F.lit(', "plan": "free"}')))
        .when(kind == "purchase", F.concat(head, props, F.lit(', "amount": '), F.col("value").cast("string"), F.lit("}")))
        .when(kind == "click", F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('"'), props, F.lit("}")))
        .when(kind == "view", F.concat(head, props, F.lit(', "amount": null}')))
        .when(F.col("event_id") % 2 == 0, F.concat(head, F.lit(', "code":')))
        .otherwise(F.concat(head, F.lit(', "code": 500}')))
    )
    table(spark, sf_dir, "events").select(text.alias("value")).write.text(path)
    return path


@query(
    "src_json_variant",
    f"""WITH {SENT} SELECT CASE WHEN NOT cut THEN event_id END AS id, CASE WHEN event_type <> 'error' THEN k END AS k,
    CASE WHEN event_type = 'purchase' THEN value END AS amount,
    CASE WHEN event_type = 'signup' THEN 'free' END AS plan,
    CASE WHEN cut THEN '{{"id": ' || event_id || ', "code":' END AS bad FROM sent""",
)
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields taken from payloads of several shapes; cut records are kept as text."""
    rows = sources.read_payloads(spark, landed_payloads(spark, sf_dir))
    return rows.select(
        sources.field_of("payload", "$.id", "bigint").alias("id"),
        sources.field_of("payload", "$.props.k", "int").alias("k"),
        sources.field_of("payload", "$.amount", "double").alias("amount"),
        sources.field_of("payload", "$.plan", "string").alias("plan"),
        "bad",
    )


@query(
    "sch_variant_drift",
    f"""WITH {SENT}, found AS (
      SELECT 'id' AS field, CASE event_type WHEN 'click' THEN 'STRING' ELSE 'BIGINT' END AS type,
        CASE event_type WHEN 'click' THEN 'other type' ELSE 'declared' END AS status FROM sent WHERE NOT cut
      UNION ALL SELECT 'props', 'OBJECT', 'declared' FROM sent WHERE event_type <> 'error'
      UNION ALL SELECT 'plan', 'STRING', 'unknown' FROM sent WHERE event_type = 'signup'
      UNION ALL SELECT 'amount', 'DECIMAL', 'declared' FROM sent WHERE event_type = 'purchase'
      UNION ALL SELECT 'amount', 'VOID', 'null' FROM sent WHERE event_type = 'view'
      UNION ALL SELECT 'code', 'BIGINT', 'unknown' FROM sent WHERE event_type = 'error' AND NOT cut)
    SELECT field, type, status, COUNT(*) AS row_count FROM found GROUP BY ALL""",
)
def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields the payloads have, of which types, beside what is declared."""
    rows = sources.read_payloads(spark, landed_payloads(spark, sf_dir))
    return sources.field_types(rows, "payload", SENT_FIELDS)
