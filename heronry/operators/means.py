"""Totals and means of any doubles that do not depend on the order or the split of the rows.

:func:`heronry.functions.numbers.exact_sum` needs values with a known number of decimals. Here each value is
split by its exponent: all values of one exponent are whole multiples of one power of two, so their sums
are sums of whole numbers, which have one result however they are dealt out. The few sums of a group (one
pair for each exponent that occurs) are then combined once, largest first, in a pair of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A value of exponent e is a whole number of up to 55 bits times 2**(e - SHIFT), also where the rounded
# logarithm is one off.
SHIFT = 53
# The whole numbers are summed in two parts, so that a bigint holds the sums of 2**35 rows.
LOW_BITS = 27
# Sums are turned into doubles in parts that a double holds exactly.
PART_BITS = 31


def _times_power(value: Column, power: Column) -> Column:
    """``value * 2**power`` in two steps, because the power alone may be out of range."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _upper(value: Column, bits: int) -> Column:
    """A bigint without its lowest bits, towards zero: no part is larger than the whole."""
    return F.when(value < 0, -F.shiftright(-value, bits)).otherwise(F.shiftright(value, bits))


def order_free_totals(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys``, ``total``, ``count`` and ``mean`` of a double column.

    Nulls are not counted; a group without values has a null total and mean, and without ``keys`` an
    empty table gives one such row. NaN and infinities give what a double sum gives, and so does a total
    out of range. All else is the exact sum, rounded once, unless values of more than 100 bits apart cancel
    each other. Repeated rows all count; other columns are not read.

    Both aggregations combine before their shuffle: a hot key sends one row for each task and exponent.
    """
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    power = F.when(finite & (x != 0), F.floor(F.log2(F.abs(x))).cast("int"))
    units = F.coalesce(
        _times_power(x, SHIFT - F.col("__power")).cast("bigint"), F.lit(0).cast("bigint")
    )
    by_power = (
        df.select(*keys, x.alias("__x"), power.alias("__power"), (~finite).alias("__odd"))
        .select(
            *keys,
            "__power",
            F.when(F.col("__odd"), F.col("__x")).alias("__odd"),
            F.col("__x").isNotNull().cast("bigint").alias("__n"),
            F.when(F.col("__power").isNotNull(), F.col("__x")).alias(value),
        )
        .withColumn("__units", units)
        .withColumn("__high", _upper(F.col("__units"), LOW_BITS))
        .groupBy(*keys, "__power")
        .agg(
            F.sum("__high").alias("high"),
            F.sum(F.col("__units") - F.shiftleft("__high", LOW_BITS)).alias("low"),
            F.sum("__odd").alias("__odd"),
            F.sum("__n").alias("__n"),
        )
    )
    # At most one entry for each exponent of a double (some 2,100).
    sums = F.collect_list(
        F.when(F.col("__power").isNotNull(), F.struct(F.col("__power").alias("power"), "high", "low"))
    )
    grouped = by_power.groupBy(*keys).agg(
        F.reverse(F.sort_array(sums)).alias("__sums"),
        F.sum("__odd").alias("__odd"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("count"),
    )
    total = F.coalesce(F.col("__odd"), _combined(F.col("__sums")))
    return grouped.select(
        *keys, F.when(F.col("count") > 0, total).alias("total"), "count"
    ).withColumn("mean", F.try_divide("total", "count"))


def _combined(sums: Column) -> Column:
    def parts(s: Column) -> Column:
        made = []
        for name, bits in (("high", LOW_BITS), ("low", 0)):
            upper = _upper(s[name], PART_BITS)
            lower = s[name] - F.shiftleft(upper, PART_BITS)
            for part, more in ((upper, bits + PART_BITS), (lower, bits)):
                scaled = _times_power(part.cast("double"), s["power"] - SHIFT + more)
                made.append(F.when(part == 0, F.lit(0.0)).otherwise(scaled))
        return F.array(*made)

    def add(pair: Column, x: Column) -> Column:
        # The sum of two doubles, and exactly what its rounding lost.
        new = pair["sum"] + x
        back = new - pair["sum"]
        lost = (pair["sum"] - (new - back)) + (x - back)
        return F.struct(new.alias("sum"), (pair["lost"] + lost).alias("lost"))

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("lost"))
    terms = F.flatten(F.transform(sums, parts))
    return F.aggregate(
        terms,
        start,
        add,
        # Beyond the range of doubles what was lost is not a number.
        lambda p: F.when(F.isnan(p["lost"]), p["sum"]).otherwise(p["sum"] + p["lost"]),
    )
