"""Grouped aggregates. All of them combine partial results before the shuffle, so a key that holds
a large share of the rows sends one partial row per task, not its rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from heronry.functions.numbers import (
    exact_avg,
    exact_sum,
    exact_total,
    from_units,
    joined_units,
    net_of_amount,
    net_of_rate,
    percentage,
    rest_total,
    to_number,
    unit_parts,
)
from heronry.functions.times import days_since, month_key


def totals(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, str],
    averages: dict[str, str] | None = None,
    count: str | None = None,
    scale: int = 2,
) -> DataFrame:
    """Sums, averages and a row count by key. ``sums`` and ``averages`` map result to input names."""
    measures = [F.count("*").alias(count)] if count else []
    measures += [exact_sum(F.col(c), scale).alias(name) for name, c in sums.items()]
    measures += [exact_avg(F.col(c), scale).alias(name) for name, c in (averages or {}).items()]
    return df.groupBy(*keys).agg(*measures)


def subtotals(df: DataFrame, keys: list[str], value: str, scale: int = 2) -> DataFrame:
    """Sums by ``keys`` in a form that adds up exactly; :func:`finish_subtotals` ends it.

    The parts of the units stay bigints, which are narrower in the shuffle than decimals and are added
    again without any.
    """
    high, low = unit_parts(F.col(value), scale)
    return df.groupBy(*keys).agg(
        F.sum(high).alias("high"),
        F.sum(low).alias("low"),
        rest_total(F.col(value), scale).alias("rest"),
    )


def finish_subtotals(df: DataFrame, keys: list[str], name: str, scale: int = 2) -> DataFrame:
    """Add up :func:`subtotals` by other keys, for example after a join with the attributes of the first."""
    total = from_units(joined_units(F.sum("high"), F.sum("low")), scale, F.sum("rest"))
    return df.groupBy(*keys).agg(total.alias(name))


def whole_totals(df: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Sums of whole-number columns by key."""
    return df.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()])


def monthly_totals(
    df: DataFrame, moment: str, value: str, at_least: float, scale: int = 3
) -> DataFrame:
    """Total per calendar month, for months that reach ``at_least``.

    Values that are no numbers and rows without a month are left out.
    """
    return (
        df.select(month_key(F.col(moment)).alias("month"), to_number(F.col(value)).alias("value"))
        .dropna()
        .groupBy("month")
        .agg(exact_sum(F.col("value"), scale).alias(value))
        .where(F.col(value) >= at_least)
    )


def conversion(df: DataFrame, key: str, closed: str = "closed") -> DataFrame:
    """Leads, closed leads and the share of closed ones in percent."""
    won = F.count_if(F.col(closed))
    return df.groupBy(key).agg(
        F.count("*").alias("total_leads"),
        won.alias("closed_leads"),
        percentage(won, F.count("*")).alias("conversion_rate_percent"),
    )


# --- customer metrics -------------------------------------------------------------------------
#
# Money is kept as units of four decimals, and what lies beyond them, until the very end, so subtotals of
# any split of the transactions add up to the same totals.

METRIC_SCALE = 4
COUNTERS = [
    "total_transactions",
    "purchased_units",
    "purchased_rest",
    "total_items_purchased",
    "discount_units",
    "discount_rest",
]


def metric_parts(
    transactions: DataFrame, key: str | list[str], discount: str, date: str | None = "transaction_date"
) -> DataFrame:
    """Additive counters per ``key``. ``discount`` says what ``discount_applied`` holds:
    a ``rate`` (fraction of the gross amount) or an ``amount``. Without a ``date`` the latest one is
    left out."""
    gross, applied = F.col("gross_amount"), F.col("discount_applied")
    if discount == "rate":
        net, saved = net_of_rate(gross, applied), gross * applied
    elif discount == "amount":
        net, saved = net_of_amount(gross, applied), applied
    else:
        raise ValueError(f"discount must be 'rate' or 'amount', not {discount!r}")
    latest = [F.max(date).alias("last_update_time")] if date else []
    return transactions.groupBy(*([key] if isinstance(key, str) else key)).agg(
        F.count("transaction_id").alias("total_transactions"),
        exact_total(net, METRIC_SCALE).alias("purchased_units"),
        rest_total(net, METRIC_SCALE).alias("purchased_rest"),
        F.sum("quantity").alias("total_items_purchased"),
        exact_total(saved, METRIC_SCALE).alias("discount_units"),
        rest_total(saved, METRIC_SCALE).alias("discount_rest"),
        *latest,
    )


def add_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """Add up counters of the same keys; the result has the columns of ``parts``."""
    sums = [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in COUNTERS]
    return parts.groupBy(*keys).agg(*sums, F.max("last_update_time").alias("last_update_time"))


def finish_metrics(parts: DataFrame, as_of: date) -> DataFrame:
    """Counters as the customer metrics table, with inactivity counted up to ``as_of``."""
    return parts.select(
        "customer_id",
        "total_transactions",
        from_units(F.col("purchased_units"), METRIC_SCALE, F.col("purchased_rest")).alias(
            "total_purchased"
        ),
        "total_items_purchased",
        from_units(F.col("discount_units"), METRIC_SCALE, F.col("discount_rest")).alias(
            "total_discounts_received"
        ),
        days_since(as_of, F.col("last_update_time")).alias("days_since_last_purchase"),
        "last_update_time",
    )


def customer_metrics(transactions: DataFrame, as_of: date, discount: str) -> DataFrame:
    """Transactions, net purchases, items, discounts and recency per customer."""
    return finish_metrics(metric_parts(transactions, "customer_id", discount), as_of)


def metrics_of_orders(
    lines: DataFrame, orders: DataFrame, as_of: date, discount: str
) -> DataFrame:
    """:func:`customer_metrics` of order lines whose customer and date are those of their order.

    Lines are combined per order first: the join with the orders needs them by order anyway, and then
    moves one row for each order instead of each line. Lines without an order are left out.
    """
    return finish_metrics(add_parts(parts_of_orders(lines, orders, discount), "customer_id"), as_of)


def parts_of_orders(lines: DataFrame, orders: DataFrame, discount: str) -> DataFrame:
    """Additive counters of each order, with its customer and date."""
    parts = metric_parts(lines, "transaction_id", discount, date=None)
    dated = orders.select(
        "transaction_id", "customer_id", F.col("transaction_date").alias("last_update_time")
    )
    return parts.join(dated, "transaction_id").drop("transaction_id")
