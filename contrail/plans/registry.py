"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn`` under ``key``; ``sql`` is the oracle (None = rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    # Importing the plan modules fills the registry.
    from contrail.plans import (  # noqa: F401
        analytics, maintenance, protection, quality, scalars, scoring, sketches, sources, streams,
    )
