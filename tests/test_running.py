"""Running totals, above all for keys that are cut into pieces, against a plain loop."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from heronry.operators.running import (
    add_key_totals,
    key_totals,
    running_average,
    running_totals,
)

SCHEMA = "id bigint, key string, moment bigint, value double"


def brute_force(rows, start=None):
    sums, counts = defaultdict(Decimal), defaultdict(int)
    for key, (total, count) in (start or {}).items():
        sums[key], counts[key] = total, count
    expected = {}
    for row_id, key, _, value in sorted(rows, key=lambda r: (r[2], r[0])):
        if value is not None:
            sums[key] += Decimal(str(value))
            counts[key] += 1
        expected[row_id] = (float(sums[key]) if counts[key] else None, counts[key])
    return expected


def skewed(n=3000, ties=False, seed=5):
    """A third of the rows in one key, another large key, many small ones, some without a key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot"] * 10 + ["warm"] * 5 + [None] * 3 + [f"k{rng.randrange(400)}"] * 12)
        moment = 7 if ties else rng.randrange(10**6)
        value = None if rng.random() < 0.05 else rng.randrange(-10**5, 10**5) / 100
        rows.append((i, key, moment, value))
    return rows


def collected(df):
    return {r["id"]: (r["running_sum"], r["running_count"]) for r in df.collect()}


@pytest.fixture(params=["1", "4", "40"])
def pieces(spark, request):
    """Numbers of pieces that the rows are cut into; adaptive execution may not merge them."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (request.param, "false")):
        spark.conf.set(name, value)
    yield int(request.param)
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.mark.parametrize("ties", [False, True])
def test_totals(spark, pieces, ties):
    rows = skewed(ties=ties)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    totals = running_totals(df, "key", ["moment", "id"], "value")
    assert collected(totals) == brute_force(rows)


def test_hot_key_is_spread(spark, pieces):
    rows = [(i, "hot", i, 1.0) for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    totals = running_totals(df, "key", ["moment", "id"], "value")
    assert collected(totals) == brute_force(rows)


def test_nothing_is_rounded(spark):
    rows = [(i, "a", i, 0.004) for i in range(1000)] + [(-1, "b", 0, 1.2345), (-2, "c", 0, 1e17)]
    got = collected(running_totals(spark.createDataFrame(rows, SCHEMA), "key", ["moment", "id"], "value"))
    assert got[999][0] == pytest.approx(4.0, abs=1e-9)
    assert got[-1] == (1.2345, 1) and got[-2] == (1e17, 1)


def test_start_from_earlier_totals(spark, pieces):
    old, new = skewed(900, seed=1), skewed(900, seed=2)
    before = defaultdict(lambda: [Decimal(0), 0])
    for _, key, _, value in old:
        if value is not None:
            before[key][0] += Decimal(str(value))
            before[key][1] += 1
    halves = [old[:400], old[400:]]
    parts = [key_totals(spark.createDataFrame(h, SCHEMA), "key", "value") for h in halves]
    earlier = add_key_totals(parts[0].unionByName(parts[1]), "key")
    totals = running_totals(
        spark.createDataFrame(new, SCHEMA),
        "key",
        ["moment", "id"],
        "value",
        earlier=earlier,
    )
    assert collected(totals) == brute_force(new, {k: tuple(v) for k, v in before.items()})


def test_average(spark):
    rows = [(1, "a", 1, 1.5), (2, "a", 2, None), (3, "a", 3, 2.5), (4, "b", 1, None)]
    df = running_average(spark.createDataFrame(rows, SCHEMA), "key", ["moment", "id"], "value")
    assert {r["id"]: r["running_avg"] for r in df.collect()} == {1: 1.5, 2: 1.5, 3: 2.0, 4: None}


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert running_totals(df, "key", ["moment", "id"], "value").count() == 0
