"""Named queries over the given tables, each with an independent SQL twin.

``register(key, sql)`` records a function ``fn(t: Tables) -> DataFrame`` and
the DuckDB SQL that must give the same rows.  The SQL may reference the
business views (``v_orders`` ...); ``with_views`` inlines them as CTEs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from depot.sources.adapter_sql import with_views
from depot.sources.tables import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, tuple[str, dict[str, str] | None]] = {}

_MODULES = ["rules", "joins", "aggregates", "windows", "sampling", "expansion",
            "tables", "quality", "sources", "streams"]


def register(key: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    def deco(fn):
        if key in _QUERIES:
            raise ValueError(f"duplicate query {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = (sql, ctes)
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"depot.registry.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"depot.registry.{m}":
                raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: (lambda spark, sf_dir, _f=f: _f(Tables.get(spark, sf_dir))) for k, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    # views are composed late: shared views may be defined by any module
    return {k: with_views(sql, ctes) for k, (sql, ctes) in _SQL.items()}
