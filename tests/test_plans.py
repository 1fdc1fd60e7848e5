"""What the physical plans must and must not contain, whatever the size of the tables."""

import re

import pytest
from pyspark.sql import functions as F

from heronry.plans import all_queries
from heronry.plans.views import opportunities

QUERIES = all_queries()
BATCH = sorted(
    n
    for n in QUERIES
    if n.startswith(("agg_", "flt_", "join_", "proj_", "rpt_", "scl_", "sort_", "topk_", "win_", "keyed_"))
)
# Compare every row with a one-row mean.
AGAINST_ONE_ROW = {"join_scalar_subquery", "rpt_vip"}


@pytest.fixture
def big(spark):
    """Tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(big, sf_dir, name):
    plan = plan_of(QUERIES[name](big, sf_dir))
    assert "CartesianProduct" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    assert ("NestedLoopJoin" in plan) == (name in AGAINST_ONE_ROW)
    assert "SinglePartition" not in plan or name in {
        *AGAINST_ONE_ROW, "agg_ratio_of_totals_avg", "rpt_avg_spend", "flt_quality_rule_report"
    }


def test_top_n_is_cut_before_the_shuffle(big, sf_dir):
    plan = plan_of(QUERIES["win_topn_per_group"](big, sf_dir))
    assert re.search(r"WindowGroupLimit.*row_number\(\), 10, Partial", plan)


def test_filters_reach_the_scan(big, sf_dir):
    assert "EqualTo(customer_id,42)" in plan_of(QUERIES["flt_point_lookup"](big, sf_dir))
    metrics = QUERIES["agg_customer_metrics_pct"](big, sf_dir).where("customer_id = 42")
    assert "EqualTo(o_custkey,42)" in plan_of(metrics)
    assert "GreaterThan(o_totalprice,100000.0)" in plan_of(QUERIES["agg_sum_avg_two_keys"](big, sf_dir))


def test_scans_read_only_what_is_used(big, sf_dir):
    plan = plan_of(QUERIES["agg_store_revenue"](big, sf_dir))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in plan


def test_hot_join_key_is_split(big, sf_dir):
    """With a third of the orders at one customer, adaptive execution splits that customer."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: big.conf.get(k) for k in small}
    for k, v in small.items():
        big.conf.set(k, v)
    try:
        orders = big.range(0, 30000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("customer"), "id"
        )
        customers = big.range(30000).select(F.col("id").alias("customer"), F.lit("x").alias("segment"))
        joined = orders.join(customers, "customer", "left").groupBy("segment").count()
        assert joined.collect()[0]["count"] == 30000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            big.conf.set(k, v)


def test_places_are_joined_to_customers_first(big, sf_dir):
    plan = plan_of(opportunities(big, sf_dir))
    assert plan.index("o_custkey") < plan.index("c_nationkey")


def test_period_opens_only_its_months(big, sf_dir):
    df = QUERIES["snk_partitioned_metrics"](big, sf_dir)
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    filters = scan.partitionFilters().mkString(" ")
    assert re.search(r"updated_month#\d+ >= 2001-01-01", filters)
    assert re.search(r"updated_month#\d+ <= 2001-06-30", filters)
