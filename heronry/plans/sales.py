"""Queries over opportunities, products and store sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.functions.mappings import weather_condition
from heronry.functions.numbers import to_number, to_whole_number
from heronry.functions.texts import clean_names
from heronry.functions.times import from_epoch, month_key, to_moment, week_from_first_monday, weekday_from_monday
from heronry.operators import aggregates, filters, joins, projections, ranking
from heronry.plans import sql
from heronry.plans.registry import plain, query
from heronry.plans.views import (
    clicks,
    opportunities,
    products,
    raw_customers,
    raw_orders,
    sales,
    stores,
    table,
    transactions,
)

OPP = f"WITH {sql.OPPORTUNITIES}"
STAR = f"WITH {sql.STAR}"
PRODUCTS = f"WITH {sql.PRODUCTS}"

OPP_COLUMNS = """lead_id, CAST(created_date AS VARCHAR) AS created_date, salesperson, lead_name,
    segment, region, CAST(target_close AS VARCHAR) AS target_close, forecast_revenue, stage,
    weighted_revenue, closed, active"""


# --- projections ------------------------------------------------------------------------------


@query("proj_full_scan", f"{OPP} SELECT {OPP_COLUMNS} FROM opp")
def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(opportunities(spark, sf_dir).select("*"))


@query(
    "proj_rename_cols",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS action,
    CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events""",
)
def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    activity = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string"), "event_type", seconds.alias("timestamp")
    )
    return projections.rename(activity, {"event_type": "action", "timestamp": "ts"})


@query(
    "proj_sanitize_names",
    """SELECT p_partkey AS Part_Key, p_name AS NameOfPart, p_brand AS "Brand-2",
    p_retailprice AS Price_USD FROM part""",
)
def sanitized(spark: SparkSession, sf_dir: str) -> DataFrame:
    awkward = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Key"),
        F.col("p_name").alias("{Name}Of;Part\n"),
        F.col("p_brand").alias("Brand-2\t"),
        F.col("p_retailprice").alias("Price (USD)="),
    )
    return clean_names(awkward)


def _split(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    wide = transactions(spark, sf_dir).join(customer, F.col("customer_id") == F.col("c_custkey"))
    return projections.split_columns(
        wide,
        {
            "customers": ["customer_id", "c_name", "c_mktsegment", "c_nationkey"],
            "transactions": ["transaction_id", "customer_id", "product_id", "transaction_date", "quantity"],
        },
    )


@query(
    "proj_vertical_split",
    f"""WITH {sql.TRANSACTIONS} SELECT customer_id, c_name, c_mktsegment, c_nationkey
    FROM tx JOIN customer ON customer_id = c_custkey""",
)
def split_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)["customers"]


@query(
    "proj_vertical_split_transactions",
    f"""WITH {sql.TRANSACTIONS} SELECT transaction_id, customer_id, product_id, transaction_date,
    quantity FROM tx JOIN customer ON customer_id = c_custkey""",
)
def split_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)["transactions"]


@query(
    "proj_flatten_nested",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events",
)
def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("props")
    )
    return projections.flatten(nested, "props", "props_")


@query(
    "proj_reshape_click",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, '/page/' || json_extract_string(props, '$.k') AS page,
    event_type AS action, 1 AS "count", value AS total_duration, ts AS processing_time,
    CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 50 THEN 'mobile' ELSE 'desktop' END
    AS device FROM events""",
)
def reshaped_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = projections.reshape_click(clicks(spark, sf_dir))
    return activity.withColumn("processing_time", F.col("processing_time").cast("timestamp_ntz"))


@query(
    "proj_total_value",
    f"{PRODUCTS} SELECT product_id, price * stock AS total_value FROM products",
)
def stock_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.with_total_value(products(spark, sf_dir)).select("product_id", "total_value")


# --- filters ----------------------------------------------------------------------------------


@query("flt_gt_const", f"{OPP} SELECT {OPP_COLUMNS} FROM opp WHERE forecast_revenue > 100000")
def large_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(filters.above(opportunities(spark, sf_dir), "forecast_revenue", 100000))


@query(
    "flt_conj_eq_gt",
    f"{PRODUCTS} SELECT * FROM products WHERE availability = 'in_stock' AND stock > 0",
)
def available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.in_stock(products(spark, sf_dir))


@query("flt_bool_pair", f"{OPP} SELECT {OPP_COLUMNS} FROM opp WHERE active AND NOT closed")
def still_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(filters.open_deals(opportunities(spark, sf_dir)))


@query(
    "flt_not_null",
    f"""WITH {sql.TRANSACTIONS} SELECT transaction_id, customer_id, discount_applied FROM tx
    WHERE discount_applied IS NOT NULL""",
)
def discounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.known(transactions(spark, sf_dir), "discount_applied").select(
        "transaction_id", "customer_id", "discount_applied"
    )


RAW_ORDERS = """raw_orders AS (
  SELECT CASE WHEN l_tax > 0 THEN l_orderkey END AS order_id, o_custkey AS customer_id,
         CAST(l_quantity - 3 AS INTEGER) AS quantity, l_extendedprice AS price,
         o_orderdate AS order_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def order_rules() -> dict:
    return {"order_id": F.col("order_id").isNotNull(), "quantity": F.col("quantity") > 0}


@query(
    "flt_quality_rule",
    f"WITH {RAW_ORDERS} SELECT * FROM raw_orders WHERE order_id IS NOT NULL AND quantity > 0",
)
def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.meets(raw_orders(spark, sf_dir), order_rules())


@query(
    "flt_quality_rule_report",
    f"""WITH {RAW_ORDERS} SELECT COUNT(*) AS row_count,
    COUNT(*) FILTER (WHERE order_id IS NOT NULL AND quantity > 0) AS kept,
    COUNT(*) FILTER (WHERE order_id IS NULL) AS failed_order_id,
    COUNT(*) FILTER (WHERE quantity <= 0) AS failed_quantity FROM raw_orders""",
)
def order_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.quality_report(raw_orders(spark, sf_dir), order_rules())


@query(
    "flt_between_date",
    f"""{OPP} SELECT {OPP_COLUMNS} FROM opp
    WHERE target_close BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'""",
)
def closing_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        filters.between_dates(
            opportunities(spark, sf_dir), "target_close", date(1998, 1, 1), date(1998, 6, 30)
        )
    )


@query("flt_like_substr", f"{PRODUCTS} SELECT * FROM products WHERE product_name LIKE '%ring%'")
def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.containing(products(spark, sf_dir), "product_name", "ring")


@query(
    "flt_in_list",
    "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view')",
)
def clicks_and_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.one_of(table(spark, sf_dir, "events"), "event_type", ["click", "view"]).select(
        "event_id", "event_type", "value"
    )


@query(
    "flt_post_agg",
    f"""SELECT user_id, {sql.exact('value')} AS spent FROM events GROUP BY user_id
    HAVING SUM(CAST(value AS DECIMAL(12,2))) > 2000""",
)
def heavy_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = aggregates.totals(table(spark, sf_dir, "events"), ["user_id"], {"spent": "value"})
    return filters.above(spent, "spent", 2000)


# --- joins ------------------------------------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = products(spark, sf_dir).select("product_id", "product_name", "category")
    return joins.star(sales(spark, sf_dir), items, stores(spark, sf_dir))


@query(
    "join_left_chain",
    f"""{STAR} SELECT product_id, store_id, sold AS date, quantity, revenue, product_name, category,
    store_name, region FROM star""",
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir)


ENRICHED_SQL = f"""WITH {RAW_ORDERS} SELECT order_id, customer_id,
    c_name AS customer_name, quantity, price,
    order_timestamp FROM raw_orders LEFT JOIN customer ON customer_id = c_custkey
    WHERE order_id IS NOT NULL AND quantity > 0"""


@query("join_left_enrich", ENRICHED_SQL)
def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.enrich_orders(clean_orders(spark, sf_dir), raw_customers(spark, sf_dir))


# --- aggregates -------------------------------------------------------------------------------


@query(
    "agg_sum_by_key_sorted",
    f"""{PRODUCTS} SELECT category, {sql.exact('price')} AS amount FROM products
    WHERE stock > 10 GROUP BY category""",
)
def amount_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    stocked = filters.above(products(spark, sf_dir), "stock", 10)
    return ranking.descending(
        aggregates.totals(stocked, ["category"], {"amount": "price"}), "amount", "category"
    )


@query(
    "agg_avg_by_key",
    f"""{PRODUCTS} SELECT brand, {sql.exact('price')} / COUNT(price) AS avg_price FROM products
    WHERE price IS NOT NULL GROUP BY brand""",
)
def price_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = filters.known(products(spark, sf_dir), "price")
    return ranking.descending(
        aggregates.totals(priced, ["brand"], {}, {"avg_price": "price"}), "avg_price", "brand"
    )


@query(
    "agg_stock_by_category",
    f"""{PRODUCTS} SELECT category, CAST(SUM(stock) AS BIGINT) AS total_stock FROM products
    WHERE stock IS NOT NULL GROUP BY category""",
)
def stock_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = filters.known(products(spark, sf_dir), "stock")
    return ranking.descending(
        aggregates.whole_totals(counted, ["category"], {"total_stock": "stock"}),
        "total_stock",
        "category",
    )


@query(
    "agg_sum_avg_two_keys",
    f"""{OPP} SELECT region, stage, CAST(SUM(weighted) AS DOUBLE) AS total_weighted_revenue,
    CAST(SUM(weighted) AS DOUBLE) / COUNT(*) AS average_weighted_revenue FROM opp
    WHERE forecast_revenue > 100000 GROUP BY region, stage""",
)
def revenue_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = filters.above(opportunities(spark, sf_dir), "forecast_revenue", 100000)
    return aggregates.totals(
        large,
        ["region", "stage"],
        {"total_weighted_revenue": "weighted_revenue"},
        {"average_weighted_revenue": "weighted_revenue"},
        scale=3,
    )


@query(
    "agg_month_sum_having",
    f"""{OPP} SELECT strftime(created_date, '%Y-%m') AS month,
    CAST(SUM(weighted) AS DOUBLE) AS weighted_revenue FROM opp GROUP BY 1
    HAVING SUM(weighted) >= 10000""",
)
def strong_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.monthly_totals(
        opportunities(spark, sf_dir), "created_date", "weighted_revenue", 10000
    )


@query(
    "agg_month_category_trend",
    f"""{STAR} SELECT CAST(year(sold) AS INTEGER) AS year, CAST(month(sold) AS INTEGER) AS month,
    category, CAST(SUM(revenue_exact) AS DOUBLE) AS total_revenue FROM star GROUP BY 1, 2, 3""",
)
def category_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = products(spark, sf_dir).select("product_id", "category")
    day = F.to_date("date")
    dated = sales(spark, sf_dir).select(
        "product_id", "revenue", F.year(day).alias("year"), F.month(day).alias("month")
    )
    # A product has few sales a month, so combining them first would shuffle nearly all rows once more than
    # the join does, and not at all where the products are small enough to be sent.
    grouped = dated.join(items, "product_id", "left")
    return aggregates.totals(
        grouped, ["year", "month", "category"], {"total_revenue": "revenue"}
    ).orderBy("year", "month", "category")


@query(
    "agg_region_segment",
    f"""{OPP} SELECT region, segment, COUNT(*) AS total_opportunities,
    CAST(SUM(forecast) AS DOUBLE) AS total_forecasted_revenue,
    CAST(SUM(weighted) AS DOUBLE) AS total_weighted_revenue FROM opp GROUP BY region, segment""",
)
def revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = aggregates.totals(
        opportunities(spark, sf_dir),
        ["region", "segment"],
        {
            "total_forecasted_revenue": "forecast_revenue",
            "total_weighted_revenue": "weighted_revenue",
        },
        count="total_opportunities",
        scale=3,
    )
    return ranking.descending(grouped, "total_forecasted_revenue", "region", "segment")


@query(
    "agg_conversion_rate",
    f"""{OPP} SELECT salesperson, COUNT(*) AS total_leads,
    COUNT(*) FILTER (WHERE closed) AS closed_leads,
    round(CAST(COUNT(*) FILTER (WHERE closed) AS DOUBLE) / COUNT(*) * 100, 2)
      AS conversion_rate_percent FROM opp GROUP BY salesperson""",
)
def conversion_by_salesperson(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = aggregates.conversion(opportunities(spark, sf_dir), "salesperson")
    return ranking.descending(rates, "conversion_rate_percent", "salesperson")


@query(
    "agg_partition_range",
    f"""{OPP} SELECT region, COUNT(*) AS total_opportunities,
    CAST(SUM(weighted) AS DOUBLE) AS total_weighted_revenue FROM opp
    WHERE target_close BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' GROUP BY region""",
)
def revenue_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = filters.between_dates(
        opportunities(spark, sf_dir), "target_close", date(1998, 1, 1), date(1998, 6, 30)
    )
    grouped = aggregates.totals(
        dated,
        ["region"],
        {"total_weighted_revenue": "weighted_revenue"},
        count="total_opportunities",
        scale=3,
    )
    return ranking.descending(grouped, "total_weighted_revenue", "region")


@query(
    "agg_salesperson_region",
    f"""{OPP} SELECT salesperson, region, CAST(SUM(forecast) AS DOUBLE) AS total_forecasted_revenue,
    CAST(SUM(weighted) AS DOUBLE) AS total_weighted_revenue FROM opp
    WHERE active AND NOT closed GROUP BY salesperson, region""",
)
def open_by_salesperson(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = aggregates.totals(
        filters.open_deals(opportunities(spark, sf_dir)),
        ["salesperson", "region"],
        {
            "total_forecasted_revenue": "forecast_revenue",
            "total_weighted_revenue": "weighted_revenue",
        },
        scale=3,
    )
    return ranking.descending(grouped, "total_forecasted_revenue", "salesperson", "region")


def _product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity by region and product. Names belong to the product number, so they are looked up
    for the groups, not for every sale: one shuffle of the sales less."""
    placed = sales(spark, sf_dir).join(
        stores(spark, sf_dir).select("store_id", "region"), "store_id", "left"
    )
    sold = aggregates.whole_totals(placed, ["region", "product_id"], {"total_quantity": "quantity"})
    names = products(spark, sf_dir).select("product_id", "product_name")
    return sold.join(names, "product_id", "left").select(
        "region", "product_id", "product_name", "total_quantity"
    )


PRODUCT_SALES = f"""{STAR}, sold AS (SELECT region, product_id, product_name,
    CAST(SUM(quantity) AS BIGINT) AS total_quantity FROM star
    GROUP BY region, product_id, product_name)"""


@query("agg_product_region_qty", f"{PRODUCT_SALES} SELECT * FROM sold")
def quantity_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _product_sales(spark, sf_dir)


def _store_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by store; names and regions are joined to the totals."""
    totals = aggregates.totals(sales(spark, sf_dir), ["store_id"], {"total_revenue": "revenue"})
    return totals.join(stores(spark, sf_dir), "store_id", "left").select(
        "store_id", "store_name", "region", "total_revenue"
    )


STORE_REVENUE = f"""{STAR}, performance AS (SELECT store_id, store_name, region,
    CAST(SUM(revenue_exact) AS DOUBLE) AS total_revenue FROM star
    GROUP BY store_id, store_name, region)"""


@query("agg_store_revenue", f"{STORE_REVENUE} SELECT * FROM performance")
def store_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store_revenue(spark, sf_dir)


@query(
    "topk_best_store",
    f"{STORE_REVENUE} SELECT * FROM performance ORDER BY total_revenue DESC, store_id LIMIT 1",
)
def best_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top(_store_revenue(spark, sf_dir), 1, "total_revenue", "store_id")


@query(
    "topk_worst_store",
    f"{STORE_REVENUE} SELECT * FROM performance ORDER BY total_revenue, store_id LIMIT 1",
)
def worst_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.bottom(_store_revenue(spark, sf_dir), 1, "total_revenue", "store_id")


@query(
    "win_topn_per_group",
    f"""{PRODUCT_SALES}, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY region
    ORDER BY total_quantity DESC, product_id) AS INTEGER) AS rank FROM sold)
    SELECT * FROM ranked WHERE rank <= 10""",
)
def best_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranked before the names are joined: only ten products per region need one.
    placed = sales(spark, sf_dir).join(
        stores(spark, sf_dir).select("store_id", "region"), "store_id", "left"
    )
    sold = aggregates.whole_totals(placed, ["region", "product_id"], {"total_quantity": "quantity"})
    best = ranking.top_per_group(sold, "region", 10, "total_quantity", "product_id")
    names = products(spark, sf_dir).select("product_id", "product_name")
    return best.join(names, "product_id", "left").select(
        "region", "product_id", "product_name", "total_quantity", "rank"
    )


@query(
    "sort_multi_key",
    f"""{OPP} SELECT CAST(year(created_date) AS INTEGER) AS year,
    CAST(month(created_date) AS INTEGER) AS month, segment,
    CAST(SUM(forecast) AS DOUBLE) AS total_forecasted_revenue FROM opp GROUP BY 1, 2, 3
    ORDER BY 1, 2, 3""",
)
def segments_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = opportunities(spark, sf_dir).select(
        F.year("created_date").alias("year"),
        F.month("created_date").alias("month"),
        "segment",
        "forecast_revenue",
    )
    return aggregates.totals(
        dated, ["year", "month", "segment"], {"total_forecasted_revenue": "forecast_revenue"}
    ).orderBy("year", "month", "segment")


@query(
    "sort_desc_agg",
    f"""{STAR} SELECT category, CAST(SUM(revenue_exact) AS DOUBLE) AS total_revenue FROM star
    GROUP BY category ORDER BY total_revenue DESC, category""",
)
def categories_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = products(spark, sf_dir).select("product_id", "category")
    sold = aggregates.subtotals(sales(spark, sf_dir), ["product_id"], "revenue")
    grouped = aggregates.finish_subtotals(
        sold.join(items, "product_id", "left"), ["category"], "total_revenue"
    )
    return ranking.descending(grouped, "total_revenue", "category")


# --- scalar functions -------------------------------------------------------------------------

# The weather codes of functions/mappings.py, for the check.
WEATHER_SQL = """CASE WHEN code = 0 THEN 'Clear sky' WHEN code IN (1, 2, 3) THEN 'Partly cloudy'
    WHEN code IN (45, 48) THEN 'Fog' WHEN code IN (51, 53, 55) THEN 'Drizzle'
    WHEN code IN (56, 57) THEN 'Freezing drizzle' WHEN code IN (61, 63, 65) THEN 'Rain'
    WHEN code IN (66, 67) THEN 'Freezing rain' WHEN code IN (71, 73, 75) THEN 'Snow fall'
    WHEN code = 77 THEN 'Snow grains' WHEN code IN (80, 81, 82) THEN 'Rain showers'
    WHEN code IN (85, 86) THEN 'Snow showers' WHEN code = 95 THEN 'Thunderstorm'
    WHEN code IN (96, 99) THEN 'Thunderstorm with hail' ELSE 'Unknown' END"""


@query(
    "scl_weather_case",
    f"""SELECT event_id, code, {WEATHER_SQL} AS weather_condition
    FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS code FROM events)""",
)
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", code.alias("code"), weather_condition(code).alias("weather_condition")
    )


@query(
    "scl_coerce",
    """SELECT p_partkey AS product_id, CAST(p_size AS VARCHAR) AS size_text,
    TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_number,
    TRY_CAST(CASE WHEN p_size > 25 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE) AS price,
    CAST(NULL AS TIMESTAMP) AS no_date,
    CAST(p_name IS NOT NULL AS INTEGER) AS named FROM part""",
)
def coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    price_text = F.when(F.col("p_size") > 25, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").cast("string").alias("size_text"),
        to_whole_number(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("brand_number"),
        to_number(price_text).alias("price"),
        to_moment(F.col("p_name")).cast("timestamp_ntz").alias("no_date"),
        F.col("p_name").isNotNull().cast("int").alias("named"),
    )


@query(
    "scl_time_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(strftime(ts, '%W') AS INTEGER) AS week_of_year,
    CAST(month(ts) AS INTEGER) AS month_of_year, strftime(ts, '%Y-%m') AS month_key,
    strftime(ts, '%Y/%m/%d/%H%M') AS run_folder,
    date_trunc('second', ts) AS from_epoch FROM events""",
)
def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.hour(ts).alias("hour"),
        weekday_from_monday(ts).alias("day_of_week"),
        week_from_first_monday(ts).alias("week_of_year"),
        F.month(ts).alias("month_of_year"),
        month_key(ts).alias("month_key"),
        F.date_format(ts, "yyyy/MM/dd/HHmm").alias("run_folder"),
        from_epoch(F.unix_seconds(ts.cast("timestamp"))).cast("timestamp_ntz").alias("from_epoch"),
    )


@query(
    "scl_time_parts_orders",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
    CAST(strftime(o_orderdate, '%W') AS INTEGER) AS week_of_year FROM orders""",
)
def order_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        weekday_from_monday(day).alias("day_of_week"),
        week_from_first_monday(day).alias("week_of_year"),
    )
