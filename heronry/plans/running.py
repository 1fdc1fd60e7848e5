"""Running totals over event tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.operators import aggregates, filters
from heronry.operators.projections import stamp
from heronry.operators.running import running_average, running_totals
from heronry.plans import sql
from heronry.plans.registry import query
from heronry.plans.views import purchases, readings, table

RUNNING = """SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY {key} ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
RUNNING_AVG = f"""SELECT event_id, user_id AS sensor_id, value,
    CAST({RUNNING.format(key='user_id')} AS DOUBLE) / COUNT(*) OVER (PARTITION BY user_id
      ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_avg
    FROM events"""
ORDER = ["ts", "event_id"]


@query("win_running_avg", RUNNING_AVG)
def sensor_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    averaged = running_average(readings(spark, sf_dir), "sensor_id", ORDER, "value")
    return averaged.select("event_id", "sensor_id", "value", "running_avg")


@query(
    "win_running_sum_product",
    f"""SELECT event_id, event_type AS product_id, value AS amount,
    CAST({RUNNING.format(key='event_type')} AS DOUBLE) AS revenue FROM events""",
)
def product_revenue_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = running_totals(purchases(spark, sf_dir), "product_id", ORDER, "amount")
    return summed.select("event_id", "product_id", "amount", F.col("running_sum").alias("revenue"))


@query(
    "win_running_sum_flag",
    f"""SELECT * FROM (SELECT event_id, user_id, value AS amount,
    CAST({RUNNING.format(key='user_id')} AS DOUBLE) AS spending FROM events) WHERE spending > 2000""",
)
def high_value_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = running_totals(purchases(spark, sf_dir), "user_id", ORDER, "amount")
    spending = summed.select("event_id", "user_id", "amount", F.col("running_sum").alias("spending"))
    return filters.above(spending, "spending", 2000)


@query(
    "agg_revenue_by_product",
    f"SELECT event_type AS product_id, {sql.exact('value')} AS revenue FROM events GROUP BY 1",
)
def product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.totals(purchases(spark, sf_dir), ["product_id"], {"revenue": "amount"})


@query(
    "agg_spend_by_user_hv",
    f"""SELECT user_id, {sql.exact('value')} AS spending FROM events GROUP BY user_id
    HAVING SUM(CAST(value AS DECIMAL(12,2))) > 2000""",
)
def high_value_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    spending = aggregates.totals(purchases(spark, sf_dir), ["user_id"], {"spending": "amount"})
    return filters.above(spending, "spending", 2000)


@query("proj_processing_time", "SELECT event_id, value, TRUE AS stamped FROM events")
def stamped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped rows; ``stamped`` tells whether the stamp lies between the making of the query and its end."""
    made = F.lit(datetime.now(timezone.utc))
    rows = stamp(table(spark, sf_dir, "events").select("event_id", "value"))
    stamped = F.col("processing_time").between(made, F.current_timestamp())
    return rows.select("event_id", "value", stamped.alias("stamped"))
