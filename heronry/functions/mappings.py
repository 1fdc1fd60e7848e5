"""CASE mappings from codes and numbers to labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weather codes of the WMO table and their descriptions.
WEATHER_CODES: dict[str, list[int]] = {
    "Clear sky": [0],
    "Partly cloudy": [1, 2, 3],
    "Fog": [45, 48],
    "Drizzle": [51, 53, 55],
    "Freezing drizzle": [56, 57],
    "Rain": [61, 63, 65],
    "Freezing rain": [66, 67],
    "Snow fall": [71, 73, 75],
    "Snow grains": [77],
    "Rain showers": [80, 81, 82],
    "Snow showers": [85, 86],
    "Thunderstorm": [95],
    "Thunderstorm with hail": [96, 99],
}
UNKNOWN_WEATHER = "Unknown"

# Days without a purchase above which a customer falls into a churn band.
CHURN_BANDS: list[tuple[int, str]] = [(90, "High"), (60, "Medium"), (30, "Low")]
NO_CHURN = "Active"


def weather_condition(code: Column) -> Column:
    """Description of a weather code. One map lookup, whatever the number of codes."""
    pairs = [F.lit(x) for name, codes in WEATHER_CODES.items() for c in codes for x in (c, name)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit(UNKNOWN_WEATHER))


def churn_band(days_inactive: Column) -> Column:
    """Churn label by days without a purchase; bounds are exclusive."""
    label = F.lit(NO_CHURN)
    for bound, name in reversed(CHURN_BANDS):
        label = F.when(days_inactive > bound, name).otherwise(label)
    return label
