"""Registered queries: each name maps to a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the DuckDB text that must give the same rows.

Modules register on import; :func:`all_queries` imports them all.
"""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def all_queries() -> dict[str, tuple[Callable, str | None]]:
    from tejado.catalog import (coverage_queries, io_queries, lead_queries, ledger_queries, operator_queries,  # noqa: F401
                                report_queries, sales_queries, stock_queries)
    return REGISTRY
