"""Query registry: a name, a Spark function of the tables and its check SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.suite import views
from daybook.suite.views import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLE: dict[str, str] = {}

_MODULES = (
    "reporting",
    "cleaning",
    "quality",
    "relational",
    "storage",
    "stores",
    "tables",
    "documents",
    "variants",
    "expressions",
    "borders",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``sql`` may use the derived tables by name."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = views.with_derived(sql)
        return fn

    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"daybook.suite.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
