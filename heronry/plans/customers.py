"""Customer metrics and the reports over them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.operators import aggregates, filters, joins, projections, ranking, reports
from heronry.functions.mappings import churn_band
from heronry.functions.numbers import discount_amount, net_of_amount, net_of_rate
from heronry.plans import sql
from heronry.plans.registry import query
from heronry.plans.views import AS_OF, dated_orders, order_lines, table, transactions
from heronry.session import file_state, fresh_path, is_complete
from heronry.sinks.files import write_csv, write_partitioned
from heronry.sources.files import read_csv

METRICS = """customer_id bigint, total_transactions bigint, total_purchased double,
    total_items_purchased bigint, total_discounts_received double, days_since_last_purchase int,
    last_update_time timestamp_ntz"""
PERIOD = (datetime(2001, 1, 1), datetime(2001, 6, 30, 23, 59, 59))
PERIOD_SQL = "TIMESTAMP '2001-01-01 00:00:00' AND TIMESTAMP '2001-06-30 23:59:59'"
# The customer of the single-customer queries.
SOME_CUSTOMER = 42


@query("agg_customer_metrics_pct", f"WITH {sql.METRICS} SELECT * FROM metrics")
def metrics_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.metrics_of_orders(
        order_lines(spark, sf_dir), dated_orders(spark, sf_dir), AS_OF, "rate"
    )


# Where the metrics of which input files are stored.
_stored: dict[tuple, str] = {}


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer metrics as a stored table, which is what the reports read.

    Built once for each state of the input files and kept in the shared folder, sorted by customer
    inside its files, so a report costs a scan of the metrics and not another join of all order lines.
    Files that were added or rewritten make a new table.
    """
    known = (
        spark.sparkContext.applicationId,
        *(file_state(spark, f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders")),
    )
    if known not in _stored or not is_complete(spark, _stored[known]):
        _stored[known] = _build_metrics(spark, sf_dir)
    return spark.read.schema(METRICS).parquet(_stored[known])


def _build_metrics(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "customer-metrics")
    metrics_by_rate(spark, sf_dir).sortWithinPartitions("customer_id").write.parquet(path)
    return path


def build_metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics table, built anew whether or not one is stored."""
    return spark.read.schema(METRICS).parquet(_build_metrics(spark, sf_dir))


@query("agg_customer_metrics_abs", f"WITH {sql.METRICS_AMOUNT} SELECT * FROM metrics")
def metrics_by_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.metrics_of_orders(
        order_lines(spark, sf_dir, "amount"), dated_orders(spark, sf_dir), AS_OF, "amount"
    )


@query(
    "proj_gross_net_abs",
    f"""WITH {sql.TRANSACTIONS} SELECT transaction_id, customer_id,
    gross_amount * quantity AS gross_amount,
    gross_amount * quantity - discount_applied AS net_amount FROM tx""",
)
def gross_net_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).withColumnRenamed("gross_amount", "unit_price")
    return projections.with_net(
        tx, F.col("unit_price") * F.col("quantity"), lambda g: net_of_amount(g, F.col("discount_applied"))
    ).select("transaction_id", "customer_id", "gross_amount", "net_amount")


@query(
    "proj_gross_net_pct",
    f"""WITH {sql.TRANSACTIONS} SELECT transaction_id, customer_id,
    gross_amount * quantity AS gross_amount,
    CASE WHEN discount_applied IS NULL THEN gross_amount * quantity
         ELSE gross_amount * quantity * (CAST(1 AS DOUBLE) - discount_applied) END AS net_amount
    FROM tx""",
)
def gross_net_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).withColumnRenamed("gross_amount", "unit_price")
    return projections.with_net(
        tx, F.col("unit_price") * F.col("quantity"), lambda g: net_of_rate(g, F.col("discount_applied"))
    ).select("transaction_id", "customer_id", "gross_amount", "net_amount")


@query(
    "proj_discount_amount",
    """SELECT l_orderkey AS order_id, l_linenumber AS line,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
               * CAST(l_quantity AS DECIMAL(4,0)), 2) AS DOUBLE) AS discount_amount
    FROM lineitem""",
)
def discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        discount_amount(
            F.col("l_extendedprice"), F.col("l_discount"), F.col("l_quantity").cast("int")
        ).alias("discount_amount"),
    )


# The exact mean of ratios: each is a whole number of 2**-60, as none is below 2**-7, and the text of the
# whole sum is read as the nearest double.
_MEAN_OF_RATIOS = """SELECT coalesce(CAST(CAST(sum(CAST(total_purchased / total_transactions
        * CAST(1152921504606846976 AS DOUBLE) AS HUGEINT)) AS VARCHAR) AS DOUBLE)
    / CAST(1152921504606846976 AS DOUBLE) / count(total_purchased / total_transactions),
    CAST(0 AS DOUBLE)) AS avg_spend FROM metrics"""


@query("agg_ratio_of_totals_avg", f"WITH {sql.METRICS} {_MEAN_OF_RATIOS}")
def spend_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    always = (datetime(1900, 1, 1), datetime(2100, 1, 1))
    return reports.average_spend(metrics_table(spark, sf_dir), *always)


@query(
    "rpt_avg_spend",
    f"WITH {sql.METRICS} {_MEAN_OF_RATIOS} WHERE last_update_time BETWEEN {PERIOD_SQL}",
)
def spend_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_spend(metrics_table(spark, sf_dir), *PERIOD)


@query(
    "flt_between_ts_param",
    f"WITH {sql.METRICS} SELECT * FROM metrics WHERE last_update_time BETWEEN {PERIOD_SQL}",
)
def seen_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.between_moments(metrics_table(spark, sf_dir), "last_update_time", *PERIOD)


@query(
    "flt_case_predicate",
    f"WITH {sql.METRICS} SELECT * FROM metrics WHERE days_since_last_purchase BETWEEN 60 AND 90",
)
def medium_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.at_risk(metrics_table(spark, sf_dir), "Medium")


@query(
    "flt_point_lookup",
    f"WITH {sql.METRICS} SELECT * FROM metrics WHERE customer_id = {SOME_CUSTOMER}",
)
def one_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.for_key(metrics_table(spark, sf_dir), "customer_id", SOME_CUSTOMER)


@query(
    "join_scalar_subquery",
    f"""WITH {sql.METRICS} SELECT * FROM metrics
    WHERE total_purchased > (SELECT 2 * avg(total_purchased) FROM metrics)""",
)
def big_spenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.above_average(metrics_table(spark, sf_dir), "total_purchased", 2)


@query(
    "topk_param",
    f"""WITH {sql.METRICS} SELECT customer_id, total_purchased FROM metrics
    ORDER BY total_purchased DESC, customer_id LIMIT 25""",
)
def largest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = metrics_table(spark, sf_dir)
    return ranking.top(metrics, 25, "total_purchased", "customer_id").select(
        "customer_id", "total_purchased"
    )


@query(
    "topk_filtered",
    f"""WITH {sql.METRICS} SELECT customer_id, days_since_last_purchase FROM metrics
    WHERE days_since_last_purchase BETWEEN 30 AND 60
    ORDER BY days_since_last_purchase DESC, customer_id LIMIT 20""",
)
def low_risk_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = filters.at_risk(metrics_table(spark, sf_dir), "Low")
    return ranking.top(low, 20, "days_since_last_purchase", "customer_id").select(
        "customer_id", "days_since_last_purchase"
    )


@query(
    "rpt_top_customers",
    f"""WITH {sql.METRICS} SELECT customer_id, total_transactions, total_purchased,
    total_items_purchased, days_since_last_purchase FROM metrics
    ORDER BY total_purchased DESC, customer_id LIMIT 10""",
)
def report_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_customers(metrics_table(spark, sf_dir), 10)


def _risk_sql(condition: str) -> str:
    return f"""WITH {sql.METRICS} SELECT customer_id, total_transactions,
    days_since_last_purchase AS days_inactive FROM metrics WHERE {condition}
    ORDER BY days_since_last_purchase DESC, customer_id LIMIT 10"""


@query("rpt_churn_risk", _risk_sql("days_since_last_purchase > 90"))
def report_high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.churn_risk(metrics_table(spark, sf_dir), "High")


@query("rpt_churn_risk_medium", _risk_sql("days_since_last_purchase BETWEEN 60 AND 90"))
def report_medium_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.churn_risk(metrics_table(spark, sf_dir), "Medium")


@query("rpt_churn_risk_low", _risk_sql("days_since_last_purchase BETWEEN 30 AND 60"))
def report_low_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.churn_risk(metrics_table(spark, sf_dir), "Low")


@query(
    "rpt_vip",
    f"""WITH {sql.METRICS} SELECT customer_id, total_purchased AS total_sales, total_transactions,
    total_items_purchased, days_since_last_purchase FROM metrics
    WHERE total_purchased > (SELECT 2 * avg(total_purchased) FROM metrics)
      AND total_transactions > 10 AND days_since_last_purchase < 30
    ORDER BY total_purchased DESC, customer_id""",
)
def report_vip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.vip_customers(metrics_table(spark, sf_dir))


@query(
    "rpt_customer_metrics",
    f"""WITH {sql.METRICS} SELECT customer_id, total_transactions,
    total_purchased / total_transactions AS avg_transaction_value, total_items_purchased,
    total_discounts_received, days_since_last_purchase, last_update_time,
    {sql.CHURN_BAND} AS churn_risk FROM metrics WHERE customer_id = {SOME_CUSTOMER}""",
)
def report_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_profile(metrics_table(spark, sf_dir), SOME_CUSTOMER)


@query(
    "rpt_export",
    f"""WITH {sql.METRICS} SELECT *, total_purchased / total_transactions AS avg_transaction_value,
    {sql.CHURN_BAND} AS churn_risk FROM metrics
    ORDER BY total_purchased DESC, customer_id LIMIT 100""",
)
def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer report as one CSV file, read back."""
    path, report = fresh_path(spark, "export"), reports.export_report(metrics_table(spark, sf_dir), 100)
    write_csv(report, path, single=True)
    return read_csv(spark, path, report.schema)


@query(
    "scl_churn_bucket",
    f"""WITH {sql.METRICS} SELECT {sql.CHURN_BAND} AS churn_risk, COUNT(*) AS customers
    FROM metrics GROUP BY 1""",
)
def churn_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = metrics_table(spark, sf_dir).select(
        churn_band(F.col("days_since_last_purchase")).alias("churn_risk")
    )
    return banded.groupBy("churn_risk").agg(F.count("*").alias("customers"))


@query(
    "snk_partitioned_metrics",
    f"WITH {sql.METRICS} SELECT * FROM metrics WHERE last_update_time BETWEEN {PERIOD_SQL}",
)
def partitioned_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics partitioned by the month of the last purchase and clustered by customer; a report for
    a period opens only its months."""
    path = fresh_path(spark, "metrics-by-month")
    monthly = metrics_by_rate(spark, sf_dir).withColumn(
        "updated_month", F.trunc("last_update_time", "MM")
    )
    write_partitioned(monthly, path, "updated_month", "customer_id")
    stored = spark.read.schema(monthly.schema).parquet(path)
    return filters.between_moments(
        stored, "last_update_time", *PERIOD, months="updated_month"
    ).drop("updated_month")
