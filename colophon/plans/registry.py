"""Named queries of the engine and the SQL each one is compared with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function as query `name`; `sql` gives the same rows in DuckDB."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


#: Modules of this package that register queries.
MODULES = ("stats", "text", "canon", "pool", "geo", "gates", "sources", "records", "orders", "assembly", "evidence", "fields", "roundtrips", "venue_sources", "places", "shapes", "wide")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"colophon.plans.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
