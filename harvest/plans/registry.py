"""Registry of named test queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``; ``sql`` is the
    equivalent DuckDB query over the same tables (omit when not SQL-expressible)."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from harvest.plans import q_load, q_catalog, q_sources, q_scalars  # noqa: F401
