"""Registry of the queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, zoned timestamps as wall-clock ones: types every client shows alike."""
    shown = {T.DateType(): "string", T.TimestampType(): "timestamp_ntz"}
    return df.select(
        *[
            F.col(f.name).cast(shown[f.dataType]).alias(f.name) if f.dataType in shown else f.name
            for f in df.schema
        ]
    )
