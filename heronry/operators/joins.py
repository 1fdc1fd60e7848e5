"""Joins. None carries a broadcast hint for a table that can grow: Catalyst broadcasts a side whose
size is known to be small, and adaptive execution splits a hot key of a sort-merge join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def star(facts: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Facts with product and store attributes; facts without a match are kept."""
    return facts.join(products, "product_id", "left").join(stores, "store_id", "left")


def enrich_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the name of their customer; orders without a known customer are kept."""
    names = customers.select("customer_id", F.col("name").alias("customer_name"))
    return orders.join(names, "customer_id", "left").select(
        "order_id", "customer_id", "customer_name", "quantity", "price", "order_timestamp"
    )


def above_average(df: DataFrame, column: str, times: float) -> DataFrame:
    """Rows whose value exceeds ``times`` the mean of the column over all rows.

    ``df`` is used twice, so hand in a stored table rather than a long computation.
    """
    mean = df.agg((F.avg(column) * times).alias("__bar"))
    # The mean is one row by construction, so sending it to every task is safe at any size.
    return df.join(F.broadcast(mean), F.col(column) > F.col("__bar")).drop("__bar")


def matched(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of two keyed tables side by side; keys that only one of them has are kept."""
    return known.join(new, key, "full_outer")
