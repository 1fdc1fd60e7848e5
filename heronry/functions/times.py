"""Date and time column functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def to_moment(text: Column, pattern: str | None = None) -> Column:
    """Text to timestamp; unparseable text becomes null."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds, as records carry them, to a time; null for null."""
    return F.timestamp_seconds(seconds)


def month_key(moment: Column) -> Column:
    """Calendar month as ``yyyy-MM``."""
    return F.date_format(moment, "yyyy-MM")


def days_since(as_of: date | datetime, moment: Column) -> Column:
    """Whole days from ``moment`` to ``as_of``.

    ``as_of`` is an argument rather than the wall clock, so a rerun gives the same answer.
    """
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    return F.datediff(F.lit(day), moment)


def weekday_from_monday(moment: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(moment)


def week_from_first_monday(moment: Column) -> Column:
    """Week of the year counted from its first Monday; earlier days are in week 0."""
    return F.floor((F.dayofyear(moment) + 6 - F.weekday(moment)) / 7).cast("int")


def run_folder(moment: datetime) -> str:
    """Sub-folder for one run, down to the minute."""
    return moment.strftime("%Y/%m/%d/%H%M")
