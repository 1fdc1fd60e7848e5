"""Queries over the given tables."""

from __future__ import annotations

from importlib import import_module

from heronry.plans.registry import ORACLES, QUERIES, Query

MODULES = ("customers", "sales", "running", "streams", "storage", "upkeep")


def _load() -> None:
    for module in MODULES:
        import_module(f"heronry.plans.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
