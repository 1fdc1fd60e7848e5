"""Logical views over the given tables, in the vocabulary of the operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.functions.numbers import discount_amount

# "Today" of the batch reports: the last day with orders in the given tables.
AS_OF = date(2001, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the columns it has now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", "n_name", F.col("r_name").alias("region")
    )


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales opportunities: one per order, with the place and segment of its customer."""
    orders = table(spark, sf_dir, "orders")
    # Places are attached to the customers, which are far fewer than the orders.
    customer = table(spark, sf_dir, "customer").join(
        places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    status = F.col("o_orderstatus")
    chance = F.when(status == "F", 1.0).when(status == "P", 0.5).otherwise(0.1)
    day = F.to_date("o_orderdate")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("lead_id"),
            day.alias("created_date"),
            F.col("n_name").alias("salesperson"),
            F.col("c_name").alias("lead_name"),
            F.col("c_mktsegment").alias("segment"),
            "region",
            F.date_add(day, 30).alias("target_close"),
            F.col("o_totalprice").alias("forecast_revenue"),
            F.col("o_orderpriority").alias("stage"),
            (F.col("o_totalprice") * chance).alias("weighted_revenue"),
            (status == "F").alias("closed"),
            (status != "F").alias("active"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue. Sizes above 40 count as sold out."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock"),
        F.when(F.col("p_size") <= 40, "in_stock").otherwise("out_of_stock").alias("availability"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("revenue"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(
        places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), "region"
    )


def order_lines(spark: SparkSession, sf_dir: str, discount: str = "rate") -> DataFrame:
    """Order lines without what belongs to their order. A zero discount counts as none on record.
    ``discount`` selects a fraction (``rate``) or an absolute ``amount``."""
    rate = F.nullif(F.col("l_discount"), F.lit(0.0))
    gross = F.col("l_extendedprice")
    applied = rate if discount == "rate" else discount_amount(gross, rate, F.lit(1))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        gross.alias("gross_amount"),
        applied.alias("discount_applied"),
    )


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines of an order have in common."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def transactions(spark: SparkSession, sf_dir: str, discount: str = "rate") -> DataFrame:
    """Customer transactions: one per order line."""
    lines, orders = order_lines(spark, sf_dir, discount), dated_orders(spark, sf_dir)
    return lines.join(orders, "transaction_id").select(
        "transaction_id",
        "customer_id",
        "product_id",
        "transaction_date",
        "quantity",
        "gross_amount",
        "discount_applied",
        "payment_method",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ingested: untaxed lines have no order number, small ones no quantity left."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_tax") > 0, F.col("l_orderkey")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("l_quantity") - 3).cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_orderdate").alias("order_timestamp"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ingested."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name")
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("sensor_id"), "value", "ts"
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-commerce transactions; the event type stands for the product."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("product_id"),
        F.col("value").alias("amount"),
        "ts",
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as they arrive: text fields and an ISO time stamp."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("/page/"), k).alias("page"),
        F.col("event_type").alias("action"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("value").alias("duration"),
        F.when(k.cast("int") < 50, "mobile").otherwise("desktop").alias("device"),
    )
