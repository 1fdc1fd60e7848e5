"""Order-free totals against exact rational arithmetic."""

import math
import struct
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from heronry.operators.means import order_free_totals


def rows(spark, values, parts=1):
    return spark.createDataFrame([("a", v) for v in values], "k string, v double").repartition(parts)


def total(spark, values, parts=1):
    (row,) = order_free_totals(rows(spark, values, parts), ["k"], "v").collect()
    return row


def bits(value):
    return struct.pack("<d", value)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.floats(allow_nan=False, allow_infinity=False, min_value=-1e15, max_value=1e15).filter(
            lambda v: v == 0 or abs(v) > 1e-12
        ),
        min_size=1,
        max_size=40,
    )
)
def test_totals_are_exact_for_every_split(spark, values):
    expected = float(sum(map(Fraction, values), Fraction(0)))
    for order, parts in ((values, 1), (values[::-1], 3), (sorted(values), 5)):
        row = total(spark, order, parts)
        assert bits(row["total"] + 0.0) == bits(expected + 0.0)
        assert bits(row["mean"]) == bits(row["total"] / len(values))


@pytest.mark.parametrize(
    "values",
    [
        [5e-324] * 3,
        [1.7e308, -1.7e308, 1e-300],
        [2.0**1000, -(2.0**999), -(2.0**999), 3.0],
        [2.0**e for e in range(-1074, 1023, 7)],
        [math.nextafter(2.0**e, 0) for e in range(-60, 60)],
        [0.1] * 1000,
        [1e17, 1.0, -1e17],
        [0.0, -0.0],
    ],
)
def test_totals_over_the_whole_range(spark, values):
    assert total(spark, values, 3)["total"] == float(sum(map(Fraction, values), Fraction(0)))


def test_totals_of_odd_values(spark):
    assert math.isnan(total(spark, [1.0, float("nan")])["total"])
    assert total(spark, [1.0, float("inf")])["total"] == float("inf")
    assert math.isnan(total(spark, [float("-inf"), float("inf")])["total"])
    assert total(spark, [1.7e308, 1.7e308])["total"] == float("inf")
    row = total(spark, [None, 2.0, None, 4.0])
    assert (row["total"], row["count"], row["mean"]) == (6.0, 2, 3.0)
    assert tuple(total(spark, [None, None])) == ("a", None, 0, None)
    empty = rows(spark, [1.0]).limit(0)
    assert [tuple(r) for r in order_free_totals(empty, [], "v").collect()] == [(None, 0, None)]
    assert order_free_totals(empty, ["k"], "v").collect() == []


def test_groups_are_apart_and_null_keys_are_one(spark):
    data = [("a", 0.1), ("a", 0.2), (None, 1.0), (None, 2.0), ("b", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r["total"] for r in order_free_totals(df, ["k"], "v").collect()}
    assert got == {"a": float(Fraction(0.1) + Fraction(0.2)), None: 3.0, "b": None}
