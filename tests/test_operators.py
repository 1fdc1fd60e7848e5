"""Edge cases of the operators on small hand-written rows."""

import itertools
import math
from datetime import date, datetime
from fractions import Fraction

import pytest
from pyspark.sql import functions as F, types as T

from heronry.functions.mappings import WEATHER_CODES, churn_band, weather_condition
from heronry.functions.numbers import (
    discount_amount,
    exact_avg,
    exact_sum,
    percentage,
    to_number,
    to_whole_number,
)
from heronry.functions.texts import caption_text, clean_name, clean_names, strip_names
from heronry.functions.times import days_since, run_folder, to_moment, week_from_first_monday
from heronry.operators import aggregates, filters, joins, keyed, projections, ranking, reports, schemas

TX = """transaction_id bigint, customer_id bigint, transaction_date timestamp_ntz, quantity int,
    gross_amount double, discount_applied double"""
METRICS = """customer_id bigint, total_transactions bigint, total_purchased double,
    total_items_purchased bigint, total_discounts_received double, days_since_last_purchase int,
    last_update_time timestamp_ntz"""


def one(df):
    (row,) = df.collect()
    return row


def value_of(spark, column):
    return one(spark.range(1).select(column.alias("v")))["v"]


# --- functions --------------------------------------------------------------------------------


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.07] * 50
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(7)
        assert one(df.agg(exact_sum(F.col("v")).alias("s")))["s"] == 33.5


def test_sum_and_average_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert tuple(one(df.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))))) == (None, None)


def test_coercion(spark):
    assert value_of(spark, to_number(F.lit("12.5"))) == 12.5
    assert value_of(spark, to_number(F.lit("n/a"))) is None
    assert value_of(spark, to_whole_number(F.lit("x7"))) is None
    assert value_of(spark, to_moment(F.lit("no date"))) is None
    assert value_of(spark, to_moment(F.lit("2024-05-06T07:08:09")).cast("string")) == "2024-05-06 07:08:09"


def test_percentage_of_zero(spark):
    assert value_of(spark, percentage(F.lit(1), F.lit(0))) is None
    assert value_of(spark, percentage(F.lit(1), F.lit(3))) == 33.33


def test_discount_half_cent_goes_up(spark):
    assert value_of(spark, discount_amount(F.lit(1.9), F.lit(0.15), F.lit(1))) == 0.29
    assert value_of(spark, discount_amount(F.lit(10.0), F.lit(0.3), F.lit(2))) == 6.0


@pytest.mark.parametrize(
    "days,band",
    [(0, "Active"), (30, "Active"), (31, "Low"), (60, "Low"), (61, "Medium"), (90, "Medium"), (91, "High")],
)
def test_churn_bands(spark, days, band):
    assert value_of(spark, churn_band(F.lit(days))) == band


def test_weather_codes(spark):
    df = spark.range(-1, 120).select("id", weather_condition(F.col("id")).alias("w"))
    names = {c: name for name, codes in WEATHER_CODES.items() for c in codes}
    assert {r["id"]: r["w"] for r in df.collect()} == {
        i: names.get(i, "Unknown") for i in range(-1, 120)
    }
    assert value_of(spark, weather_condition(F.lit(None).cast("int"))) == "Unknown"


def test_week_numbers_match_python(spark):
    days = [date(y, m, d) for y in (2020, 2021, 2023, 2024) for m in (1, 12) for d in (1, 2, 3, 6, 7, 8, 28, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: r["w"] for r in df.select("d", week_from_first_monday(F.col("d")).alias("w")).collect()}
    assert got == {d: int(d.strftime("%W")) for d in days}


def test_days_since(spark):
    assert value_of(spark, days_since(datetime(2024, 3, 1, 5), F.lit("2024-02-01").cast("timestamp_ntz"))) == 29


def test_run_folder():
    assert run_folder(datetime(2024, 2, 3, 4, 5, 59)) == "2024/02/03/0405"


def test_caption_text(spark):
    captions = (
        "WEBVTT\r\n\r\nNOTE\r\nMade by hand\r\n\r\n00:01.000 --> 00:02.000\r\n  A first line  \r\n"
        "NOTEBOOK page\r\nand a second\tone\t\n\n   \n00:03.000 --> 00:04.000\nthe NOTE stays"
    )
    assert value_of(spark, caption_text(F.lit(captions))) == (
        "WEBVTT Made by hand A first line and a second\tone the NOTE stays"
    )
    assert value_of(spark, caption_text(F.lit("\n\n"))) == ""


def test_names(spark):
    assert clean_name("Total (USD);\t={x}\n y") == "Total_USDx_y"
    with pytest.raises(ValueError, match="a_b"):
        clean_names(spark.createDataFrame([(1, 2)], ["a b", "a_(b)"]))
    assert strip_names(spark.createDataFrame([(1,)], ["  x "])).columns == ["x"]


# --- filters ----------------------------------------------------------------------------------


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, 0), (3, None), (None, -1)], "order_id int, quantity int")
    rules = {"order_id": F.col("order_id").isNotNull(), "quantity": F.col("quantity") > 0}
    assert [tuple(r) for r in filters.meets(df, rules).collect()] == [(1, 5)]
    report = one(filters.quality_report(df, rules)).asDict()
    assert report == {"row_count": 5, "kept": 1, "failed_order_id": 2, "failed_quantity": 3}


def test_open_deals_unknown_flag(spark):
    df = spark.createDataFrame([(True, False), (True, None), (None, False), (True, True)], "active boolean, closed boolean")
    assert filters.open_deals(df).count() == 1


@pytest.mark.parametrize(
    "level,days", [("High", {91, 200}), ("Medium", {60, 61, 90}), ("Low", {30, 59, 60})]
)
def test_risk_levels_overlap_at_sixty(spark, level, days):
    df = spark.createDataFrame([(d,) for d in (0, 29, 30, 59, 60, 61, 90, 91, 200)], "days_since_last_purchase int")
    assert {r[0] for r in filters.at_risk(df, level).collect()} == days


def test_unknown_risk_level(spark):
    with pytest.raises(ValueError, match="Severe"):
        filters.at_risk(spark.range(1), "Severe")


def test_missing_key_is_an_error(spark):
    df = spark.range(3)
    assert filters.fetch_one(df, "id", 2)["id"] == 2
    with pytest.raises(LookupError):
        filters.fetch_one(df, "id", 7)


def test_case_sensitive_part(spark):
    df = spark.createDataFrame([("Western Dress",), ("dress",), (None,)], "c string")
    assert [r[0] for r in filters.containing(df, "c", "Dress").collect()] == ["Western Dress"]


# --- aggregates, ranking ----------------------------------------------------------------------


def test_metrics_with_missing_discounts(spark):
    day = datetime(2024, 1, 31, 10)
    tx = spark.createDataFrame(
        [(1, 7, day, 2, 100.0, 0.1), (None, 7, datetime(2024, 1, 1), 1, 50.0, None), (3, 8, day, 1, 10.0, 0.0)],
        TX,
    )
    by_rate = {r["customer_id"]: tuple(r)[1:] for r in aggregates.customer_metrics(tx, date(2024, 2, 10), "rate").collect()}
    assert by_rate[7] == (1, 140.0, 3, 10.0, 10, day)
    assert by_rate[8] == (1, 10.0, 1, 0.0, 10, day)
    by_amount = {r["customer_id"]: tuple(r)[1:] for r in aggregates.customer_metrics(tx, date(2024, 2, 10), "amount").collect()}
    assert by_amount[7] == (1, 99.9, 3, 0.1, 10, day)
    with pytest.raises(ValueError):
        aggregates.customer_metrics(tx, date(2024, 2, 10), "percent")


def test_monthly_totals_drop_bad_rows(spark):
    df = spark.createDataFrame(
        [("2024-01-05", "9000"), ("2024-01-20", "1000.5"), ("2024-02-01", "9999.99"), ("2024-02-02", "oops"), (None, "50000")],
        "day string, revenue string",
    ).withColumn("day", F.to_date("day"))
    totals = aggregates.monthly_totals(df, "day", "revenue", 10000)
    assert [tuple(r) for r in totals.collect()] == [("2024-01", 10000.5)]


def test_conversion(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("a", None), ("b", False)], "who string, closed boolean")
    assert {tuple(r) for r in aggregates.conversion(df, "who").collect()} == {("a", 3, 1, 33.33), ("b", 1, 0, 0.0)}


def test_ties_at_the_edge_of_the_ranking(spark):
    df = spark.createDataFrame([("n", i, 5) for i in range(12)] + [("s", 1, 9)], "region string, id int, qty int")
    top = ranking.top_per_group(df, "region", 10, "qty", "id")
    assert sorted(r["id"] for r in top.where("region = 'n'").collect()) == list(range(10))
    assert one(top.where("region = 's'"))["rank"] == 1
    assert one(ranking.top(df.where("region = 'n'"), 1, "qty", "id"))["id"] == 0


def test_store_report(spark):
    """Category amounts: only rows above the bound count, largest first."""
    df = spark.createDataFrame([("x", 5, 900), ("x", 20, 80), ("y", 11, 200), ("z", 10, 10)], "category string, value int, amount int")
    totals = aggregates.whole_totals(filters.above(df, "value", 10), ["category"], {"amount": "amount"})
    assert [tuple(r) for r in ranking.descending(totals, "amount").collect()] == [("y", 200), ("x", 80)]


# --- joins, projections -----------------------------------------------------------------------


def test_star_keeps_unmatched_facts(spark):
    facts = spark.createDataFrame([(1, 1), (9, 1), (1, 9)], "product_id int, store_id int")
    items = spark.createDataFrame([(1, "ring")], "product_id int, product_name string")
    places = spark.createDataFrame([(1, "north")], "store_id int, region string")
    rows = {tuple(r) for r in joins.star(facts, items, places).select("product_id", "store_id", "product_name", "region").collect()}
    assert rows == {(1, 1, "ring", "north"), (9, 1, None, "north"), (1, 9, "ring", None)}


def test_split_with_and_without_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "a", 20)], "tx int, customer string, amount int")
    lists = {"customers": ["customer"], "tx": ["tx", "customer"]}
    assert projections.split_columns(df, lists)["customers"].count() == 2
    assert projections.split_columns(df, lists, {"customers": ["customer"]})["customers"].count() == 1


# --- keyed tables -----------------------------------------------------------------------------


def _totals(spark, rows):
    return spark.createDataFrame(rows, "k int, n bigint, days int, seen int")


def test_merge(spark):
    table = _totals(spark, [(1, 5, 10, 100), (2, 7, 20, 90), (4, None, 1, 50)])
    batch = _totals(spark, [(1, 2, 0, 110), (3, 1, 0, 105), (2, 1, 30, 80), (4, None, 0, 60)])
    newest = keyed.merge_additive(table, batch, "k", ["n"], ["days", "seen"], "seen")
    assert {tuple(r) for r in newest.collect()} == {(1, 7, 0, 110), (2, 8, 20, 90), (3, 1, 0, 105), (4, 0, 0, 60)}
    replaced = keyed.merge_additive(table, batch, "k", ["n"], ["days", "seen"], "seen", keep_newest=False)
    assert {tuple(r) for r in replaced.collect()} == {(1, 7, 0, 110), (2, 8, 30, 80), (3, 1, 0, 105), (4, 0, 0, 60)}


def test_merge_does_not_depend_on_the_order_of_its_arguments(spark):
    one = _totals(spark, [(1, 1, 10, 100), (2, 1, 7, None)])
    two = _totals(spark, [(1, 2, 99, 100), (2, 2, 3, None)])
    results = []
    for table, batch in ((one, two), (two, one)):
        merged = keyed.merge_additive(table, batch, "k", ["n"], ["days", "seen"], "seen")
        results.append({tuple(r) for r in merged.collect()})
    # All of a key's recency comes from one side, also where neither time is known.
    assert results == [{(1, 3, 99, 100), (2, 3, 7, None)}] * 2


def test_money_is_merged_exactly(spark):
    money = lambda v: spark.createDataFrame([(1, v, 1)], "k int, spent double, seen int")
    merged = keyed.merge_additive(money(0.1), money(0.2), "k", ["spent"], ["seen"], "seen")
    assert one(merged)["spent"] == 0.3


def test_sums_round_nothing(spark):
    def total(values, f=exact_sum):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return one(df.agg(f(F.col("v")).alias("s")))["s"]

    assert total([0.004] * 1000) == pytest.approx(4.0, abs=1e-9)
    assert total([1.2345], exact_avg) == 1.2345
    assert total([1e17, 2.0, None]) == 1e17 + 2.0
    assert math.isnan(total([1.0, float("nan")])) and total([float("inf"), 1.0]) == float("inf")
    cents = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9]
    assert len({total(p) for p in itertools.permutations(cents)}) == 1
    assert total([-0.01] * 3) == -0.03


def test_discounts_are_not_cut(spark):
    assert value_of(spark, discount_amount(F.lit(100.0), F.lit(0.125), F.lit(1))) == 12.5
    assert value_of(spark, discount_amount(F.lit(1.005), F.lit(1 / 3), F.lit(300))) == 100.5


def test_discounts_of_any_size_round_half_a_cent_upwards(spark):
    rows = [(p, r, q) for p in (0.0, 0.01, 28.5, -28.5, 99999.99, 123456789.01, 9e12) for r in (0.0, 0.01, 0.1, 0.285, 0.000005) for q in (1, 3, -2, 50)]
    df = spark.createDataFrame(rows, "p double, r double, q int")
    got = df.select("p", "r", "q", discount_amount(F.col("p"), F.col("r"), F.col("q")).alias("d")).collect()
    for p, r, q, d in got:
        cents = Fraction(str(p)) * Fraction(str(r)) * q * 100
        assert d == math.floor(cents + Fraction(1, 2)) / 100


def test_changes(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    changes = spark.createDataFrame(
        [(1, "x", 1, "update"), (1, "y", 2, "update"), (2, None, 1, "delete"), (4, "n", 1, "insert"),
         (5, "m", 1, "insert"), (5, None, 2, "delete"), (3, None, 1, "delete"), (3, "back", 2, "insert")],
        "id int, name string, step int, action string",
    )
    result = keyed.apply_changes(table, changes, "id", ["step"])
    assert {tuple(r) for r in result.collect()} == {(1, "y"), (4, "n"), (3, "back")}


# --- schemas ----------------------------------------------------------------------------------


def test_fit(spark):
    declared = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a.x", T.StringType()), T.StructField("c", T.DateType())])
    df = spark.createDataFrame([("1", "7", "extra"), ("2", "seven", "extra")], ["a.x", "b", "d"])
    assert [tuple(r) for r in schemas.fit(df, declared).orderBy("`a.x`").collect()] == [(7, "1", None), (None, "2", None)]
    assert schemas.fit(df, declared).columns == ["b", "a.x", "c"]


def test_types_by_name():
    names = {"customer_id": "bigint", "card_number": "bigint", "transaction_date": "timestamp_ntz",
             "unit_price": "double", "quantity": "string", "age": "string"}
    assert {n: schemas.type_by_name(n).simpleString() for n in names} == names


def test_required(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, name string")
    good, bad = schemas.require(df, "id")
    assert (good.count(), bad.count()) == (1, 1)


# --- reports ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def metrics(spark):
    seen = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(1, 12, 1000.0, 30, 1.0, 5, seen), (2, 12, 1000.0, 30, 1.0, 40, seen), (3, 11, 100.0, 5, 0.0, 95, seen),
         (4, 2, 10.0, 5, 0.0, 60, seen), (5, 10, 900.0, 1, 0.0, 1, datetime(2023, 1, 1)), (6, 0, 0.0, 0, 0.0, 400, seen)],
        METRICS,
    )


def test_top_customers_ignores_tier(metrics):
    assert [r["customer_id"] for r in reports.top_customers(metrics, 2, tier="gold").collect()] == [1, 2]


def test_average_spend_of_nobody(metrics):
    first, last = datetime(1999, 1, 1), datetime(1999, 12, 31)
    assert one(reports.average_spend(metrics, first, last))["avg_spend"] == 0.0
    assert one(reports.average_spend(metrics, datetime(2023, 1, 1), datetime(2023, 1, 1)))["avg_spend"] == 90.0


def test_churn_report(metrics):
    assert [tuple(r) for r in reports.churn_risk(metrics, "High", 1).collect()] == [(6, 0, 400)]
    assert [r["customer_id"] for r in reports.churn_risk(metrics, "Low").collect()] == [4, 2]


def test_vip(metrics):
    # The bar is twice the mean of 501.67: nobody reaches it until a large customer appears.
    assert reports.vip_customers(metrics).count() == 0
    lower = metrics.where("customer_id in (1, 3, 4, 6)")
    assert [r["customer_id"] for r in reports.vip_customers(lower).collect()] == [1]


def test_profile(metrics):
    row = reports.fetch_profile(metrics, 4)
    assert (row["avg_transaction_value"], row["churn_risk"]) == (5.0, "Low")
    with pytest.raises(LookupError):
        reports.fetch_profile(metrics, 99)


def test_export_without_transactions(metrics):
    rows = {r["customer_id"]: r for r in reports.export_report(metrics, 10).collect()}
    assert rows[6]["avg_transaction_value"] is None and rows[6]["churn_risk"] == "High"


def test_refreshed_inactivity(metrics):
    later = {r["customer_id"]: r["days_since_last_purchase"] for r in reports.refreshed(metrics, date(2024, 3, 1)).collect()}
    assert later[1] == 60 and later[5] == 425
