"""Numeric column functions: exact sums of fixed-point values, safe ratios, coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Beyond this, a double cannot tell neighbouring units apart.
MAX_UNITS = float(2**53)


def in_units(value: Column, scale: int) -> Column:
    """The whole number of ``10**-scale`` units nearest to a double; 0 for null, NaN, infinities and
    values beyond ``MAX_UNITS``, which :func:`beyond_units` then holds as they are.

    ``rint`` on the scaled double is several times cheaper than a cast to decimal, which goes
    through the decimal text of every value.
    """
    scaled = value * F.lit(float(10**scale))
    return F.when(F.abs(scaled) < MAX_UNITS, F.rint(scaled).cast("long")).otherwise(F.lit(0))


# A product of fixed-point doubles is off by a few units in the last place; this share of a value counts
# as such an error and not as further decimals.
ROUNDING = 2.0**-50


def beyond_units(value: Column, scale: int) -> Column:
    """What a double holds beyond its whole units: exactly 0 for a fixed-point value and for a product
    of such values, null for null."""
    rest = value - in_units(value, scale) / F.lit(float(10**scale))
    return F.when(F.abs(rest) < F.abs(value) * ROUNDING, F.lit(0.0)).otherwise(rest)


# Units are summed in two parts, so that neither sum can outgrow a bigint before a group has some
# trillions of rows.
LOW_BITS = 20


def exact_total(value: Column, scale: int = 2) -> Column:
    """Sum of the whole units of a double; the order of rows cannot change it.

    Two bigint sums are combined at the end: as exact as a decimal sum, nearly as cheap as a double
    one, and a third narrower in the shuffle.
    """
    return joined_units(*(F.sum(part) for part in unit_parts(value, scale)))


def unit_parts(value: Column, scale: int = 2) -> tuple[Column, Column]:
    """The two bigints into which the whole units of a double are split for summing."""
    units = in_units(value, scale)
    return F.shiftright(units, LOW_BITS), units.bitwiseAND(F.lit(2**LOW_BITS - 1))


def joined_units(high: Column, low: Column) -> Column:
    """Sums of the two parts as one exact number of units."""
    shifted = high.cast("decimal(19,0)") * F.lit(2**LOW_BITS).cast("decimal(7,0)")
    return shifted + low.cast("decimal(19,0)")


def rest_total(value: Column, scale: int = 2) -> Column:
    """Sum of what the values hold beyond their whole units; null for a group without any value."""
    return F.sum(beyond_units(value, scale))


def from_units(units: Column, scale: int = 2, rest: Column | None = None) -> Column:
    """Units, and what lies beyond them, back to a double."""
    whole = units.cast("double") / F.lit(float(10**scale))
    return whole if rest is None else whole + rest


def exact_sum(value: Column, scale: int = 2) -> Column:
    """SUM of a double column. Nothing is rounded; as far as the values have at most ``scale`` decimals
    the order of rows cannot change the result."""
    return from_units(exact_total(value, scale), scale, rest_total(value, scale))


def exact_plus(a: Column, b: Column, scale: int = 2) -> Column:
    """What :func:`exact_sum` gives for two values; a null counts as 0."""
    a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
    units = in_units(a, scale) + in_units(b, scale)
    return from_units(units, scale, beyond_units(a, scale) + beyond_units(b, scale))


def exact_avg(value: Column, scale: int = 2) -> Column:
    """AVG over the non-null values, summed as by :func:`exact_sum`; null for a group without any."""
    return F.try_divide(exact_sum(value, scale), F.count(value))


def to_number(text: Column) -> Column:
    """Text to double; anything unparseable becomes null instead of an error."""
    return text.try_cast("double")


def to_whole_number(text: Column) -> Column:
    """Text to bigint; anything unparseable becomes null instead of an error."""
    return text.try_cast("bigint")


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with two decimals; null when ``whole`` is zero."""
    return F.round(F.try_divide(part, whole) * 100, 2)


# Decimals of a rate that are counted in whole units.
RATE_SCALE = 6
# Discounts below this are multiplied as bigints: their units stay below 2**60. Larger ones take decimals,
# which are several times slower.
BIGINT_DISCOUNT = float(2**33)


def discount_amount(unit_price: Column, rate: Column, quantity: Column) -> Column:
    """Absolute discount for a line to the cent, half a cent upwards.

    Prices of two and rates of up to six decimals are multiplied as whole units, which keeps a
    product such as 0.285 from ending up just below the half; all others as doubles.
    """
    fixed = (beyond_units(unit_price, 2) == 0) & (beyond_units(rate, RATE_SCALE) == 0)
    prices, rates, cent = in_units(unit_price, 2), in_units(rate, RATE_SCALE), 10**RATE_SCALE
    plain = unit_price * rate * quantity
    more = prices * rates * quantity + F.lit(cent // 2)
    # A multiple of a cent; the division is off by far less than half a cent.
    small = F.rint((more - F.pmod(more, F.lit(cent))).cast("double") / F.lit(float(cent)))
    product = prices.cast("decimal(18,0)") * rates * quantity
    whole = F.floor((product + F.lit(cent // 2)) / F.lit(cent).cast("decimal(7,0)"))
    return (
        F.when(fixed & (F.abs(plain) < BIGINT_DISCOUNT), from_units(small))
        .when(fixed, from_units(whole))
        .otherwise(F.round(plain, 2))
    )


def net_of_amount(gross: Column, discount: Column) -> Column:
    """Net when the discount is an absolute amount; unknown discount gives an unknown net."""
    return gross - discount


def net_of_rate(gross: Column, rate: Column) -> Column:
    """Net when the discount is a fraction; without a discount the net is the gross."""
    return F.coalesce(gross * (F.lit(1.0) - rate), gross)
