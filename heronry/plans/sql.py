"""Shared parts of the checking SQL: the logical views in plain SQL, with decimal arithmetic."""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"

OPPORTUNITIES = """opp AS (
  SELECT o.o_orderkey AS lead_id, CAST(o.o_orderdate AS DATE) AS created_date,
         n.n_name AS salesperson, c.c_name AS lead_name, c.c_mktsegment AS segment,
         r.r_name AS region, CAST(o.o_orderdate AS DATE) + 30 AS target_close,
         o.o_totalprice AS forecast_revenue, o.o_orderpriority AS stage,
         o.o_totalprice * CAST(CASE o.o_orderstatus WHEN 'F' THEN 1.0 WHEN 'P' THEN 0.5
                               ELSE 0.1 END AS DOUBLE) AS weighted_revenue,
         CAST(o.o_totalprice AS DECIMAL(12,2)) AS forecast,
         CAST(o.o_totalprice AS DECIMAL(12,2))
           * CASE o.o_orderstatus WHEN 'F' THEN 1.0 WHEN 'P' THEN 0.5 ELSE 0.1 END AS weighted,
         o.o_orderstatus = 'F' AS closed, o.o_orderstatus <> 'F' AS active
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
         p_retailprice AS price, p_size AS stock,
         CASE WHEN p_size <= 40 THEN 'in_stock' ELSE 'out_of_stock' END AS availability
  FROM part)"""

STAR = """star AS (
  SELECT l.l_partkey AS product_id, l.l_suppkey AS store_id, l.l_shipdate AS sold,
         CAST(l.l_quantity AS INTEGER) AS quantity, l.l_extendedprice AS revenue,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS revenue_exact,
         p.p_name AS product_name, p.p_type AS category, s.s_name AS store_name,
         r.r_name AS region
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

TRANSACTIONS = """tx AS (
  SELECT l.l_orderkey AS transaction_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
         o.o_orderdate AS transaction_date, CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(CASE WHEN l.l_discount <> 0 THEN l.l_discount END AS DECIMAL(4,2)) AS rate,
         l.l_extendedprice AS gross_amount,
         CASE WHEN l.l_discount <> 0 THEN l.l_discount END AS discount_applied,
         o.o_orderpriority AS payment_method
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def metrics(net: str, saved: str, source: str = "tx", name: str = "metrics") -> str:
    return f"""{name} AS (
  SELECT customer_id, COUNT(transaction_id) AS total_transactions,
         CAST(SUM({net}) AS DOUBLE) AS total_purchased,
         CAST(SUM(quantity) AS BIGINT) AS total_items_purchased,
         CAST(SUM({saved}) AS DOUBLE) AS total_discounts_received,
         CAST(date_diff('day', CAST(MAX(transaction_date) AS DATE), {AS_OF}) AS INTEGER)
           AS days_since_last_purchase,
         MAX(transaction_date) AS last_update_time
  FROM {source} GROUP BY customer_id)"""


NET_RATE = "CASE WHEN rate IS NULL THEN gross ELSE gross * (1 - rate) END"
SAVED_RATE = "gross * rate"
SAVED_AMOUNT = "round(gross * rate, 2)"
NET_AMOUNT = f"gross - {SAVED_AMOUNT}"

METRICS = f"{TRANSACTIONS}, {metrics(NET_RATE, SAVED_RATE)}"
METRICS_AMOUNT = f"{TRANSACTIONS}, {metrics(NET_AMOUNT, SAVED_AMOUNT)}"

CHURN_BAND = """CASE WHEN days_since_last_purchase > 90 THEN 'High'
       WHEN days_since_last_purchase > 60 THEN 'Medium'
       WHEN days_since_last_purchase > 30 THEN 'Low' ELSE 'Active' END"""


def exact(column: str, decimals: int = 2) -> str:
    """SUM of a double column in decimal arithmetic."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(12,{decimals}))) AS DOUBLE)"
