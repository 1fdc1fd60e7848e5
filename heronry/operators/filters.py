"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Row, functions as F

# Inactivity bands of the churn report, both ends included, so 60 is in two of them.
RISK_LEVELS: dict[str, Callable[[Column], Column]] = {
    "High": lambda days: days > 90,
    "Medium": lambda days: days.between(60, 90),
    "Low": lambda days: days.between(30, 60),
}


def above(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows where ``column`` exceeds ``bound``."""
    return df.where(F.col(column) > bound)


def in_stock(df: DataFrame, availability: str = "availability", stock: str = "stock") -> DataFrame:
    """Products marked as available that have stock."""
    return df.where((F.col(availability) == "in_stock") & (F.col(stock) > 0))


def open_deals(df: DataFrame, active: str = "active", closed: str = "closed") -> DataFrame:
    """Rows that are active and not closed; an unknown flag keeps a row out."""
    return df.where(F.col(active) & ~F.col(closed))


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in every named column."""
    return df.dropna(subset=list(columns))


def meets(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that satisfy every quality rule; an unknown outcome fails."""
    kept = F.lit(True)
    for rule in rules.values():
        kept = kept & F.coalesce(rule, F.lit(False))
    return df.where(kept)


def quality_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows, rows kept, and rows failing each rule, in one pass."""
    outcome = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    kept = F.lit(True)
    for passed in outcome.values():
        kept = kept & passed
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(kept).alias("kept"),
        *[F.count_if(~passed).alias(f"failed_{name}") for name, passed in outcome.items()],
    )


def between_dates(
    df: DataFrame, column: str, first: date, last: date, months: str | None = None
) -> DataFrame:
    """Rows dated from ``first`` to ``last``, both included. On a partition column this prunes
    folders; ``months`` names a partition column with the first day of the month of ``column``."""
    chosen = F.col(column).between(F.lit(first), F.lit(last))
    return _in_months(df, first, last, months).where(chosen)


def between_moments(
    df: DataFrame, column: str, first: datetime, last: datetime, months: str | None = None
) -> DataFrame:
    """Rows stamped from ``first`` to ``last``, both included. Bounds are zone-less wall-clock times;
    ``months`` is as for :func:`between_dates`."""
    bounds = [F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (first, last)]
    return _in_months(df, first.date(), last.date(), months).where(F.col(column).between(*bounds))


def _in_months(df: DataFrame, first: date, last: date, months: str | None) -> DataFrame:
    if months is None:
        return df
    return df.where(F.col(months).between(F.lit(first.replace(day=1)), F.lit(last)))


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose text contains ``part``, case-sensitive."""
    return df.where(F.col(column).contains(part))


def at_risk(df: DataFrame, level: str, days: str = "days_since_last_purchase") -> DataFrame:
    """Customers in one inactivity band. An unknown level is an error before anything runs."""
    if level not in RISK_LEVELS:
        raise ValueError(f"level must be one of {', '.join(RISK_LEVELS)}, not {level!r}")
    return df.where(RISK_LEVELS[level](F.col(days)))


def one_of(df: DataFrame, column: str, values: list[Any]) -> DataFrame:
    """Rows whose value is in a constant list."""
    return df.where(F.col(column).isin(values))


def for_key(df: DataFrame, column: str, key: Any) -> DataFrame:
    """The rows of one key."""
    return df.where(F.col(column) == key)


def fetch_one(df: DataFrame, column: str, key: Any) -> Row:
    """The single row of a key, to the caller; a missing key is an error."""
    row = for_key(df, column, key).first()
    if row is None:
        raise LookupError(f"no row with {column} = {key!r}")
    return row
