"""Reports over the customer metrics table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Row, functions as F

from heronry.functions.mappings import churn_band
from heronry.functions.times import days_since
from heronry.operators.filters import at_risk, between_moments, fetch_one, for_key
from heronry.operators.joins import above_average
from heronry.operators.means import order_free_totals
from heronry.operators.ranking import top


def refreshed(metrics: DataFrame, as_of: date) -> DataFrame:
    """Metrics with inactivity counted up to ``as_of``. The stored number is the one of the day the
    customer last bought something, so it goes stale for everybody else."""
    return metrics.withColumn(
        "days_since_last_purchase", days_since(as_of, F.col("last_update_time"))
    )


def _average_value() -> Column:
    return F.try_divide(F.col("total_purchased"), F.col("total_transactions"))


def top_customers(metrics: DataFrame, n: int, tier: str | None = None) -> DataFrame:
    """The ``n`` customers with the largest purchases. ``tier`` is accepted and has no effect."""
    return top(metrics, n, "total_purchased", "customer_id").select(
        "customer_id",
        "total_transactions",
        "total_purchased",
        "total_items_purchased",
        "days_since_last_purchase",
    )


def average_spend(metrics: DataFrame, first: datetime, last: datetime) -> DataFrame:
    """Mean of the customers' average transaction values, for customers last seen in a time range;
    0.0 when there are none. The ratios are added exactly, so no order or split of the customers changes
    the result."""
    seen = between_moments(metrics, "last_update_time", first, last)
    mean = order_free_totals(seen.select(_average_value().alias("value")), [], "value")
    return mean.select(F.coalesce("mean", F.lit(0.0)).alias("avg_spend"))


def churn_risk(metrics: DataFrame, level: str = "High", limit: int = 10) -> DataFrame:
    """The longest inactive customers of one risk level."""
    return top(
        at_risk(metrics, level), limit, "days_since_last_purchase", "customer_id"
    ).select(
        "customer_id",
        "total_transactions",
        F.col("days_since_last_purchase").alias("days_inactive"),
    )


def vip_customers(metrics: DataFrame) -> DataFrame:
    """Recent, frequent customers with more than twice the average purchases, largest first."""
    return (
        above_average(metrics, "total_purchased", 2)
        .where((F.col("total_transactions") > 10) & (F.col("days_since_last_purchase") < 30))
        .orderBy(F.desc("total_purchased"), "customer_id")
        .select(
            "customer_id",
            F.col("total_purchased").alias("total_sales"),
            "total_transactions",
            "total_items_purchased",
            "days_since_last_purchase",
        )
    )


def customer_profile(metrics: DataFrame, customer_id: int) -> DataFrame:
    """One customer with the average transaction value and the churn label."""
    return for_key(metrics, "customer_id", customer_id).select(
        "customer_id",
        "total_transactions",
        _average_value().alias("avg_transaction_value"),
        "total_items_purchased",
        "total_discounts_received",
        "days_since_last_purchase",
        "last_update_time",
        churn_band(F.col("days_since_last_purchase")).alias("churn_risk"),
    )


def fetch_profile(metrics: DataFrame, customer_id: int) -> Row:
    """The profile row of a customer; an unknown customer is an error."""
    return fetch_one(customer_profile(metrics, customer_id), "customer_id", customer_id)


def export_report(metrics: DataFrame, limit: int = 100) -> DataFrame:
    """All metrics, average value and churn label of the customers with the largest purchases."""
    return top(metrics, limit, "total_purchased", "customer_id").select(
        "customer_id",
        "total_transactions",
        "total_purchased",
        "total_items_purchased",
        "total_discounts_received",
        "days_since_last_purchase",
        "last_update_time",
        _average_value().alias("avg_transaction_value"),
        churn_band(F.col("days_since_last_purchase")).alias("churn_risk"),
    )
