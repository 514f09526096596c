"""Registry of named queries and their DuckDB oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame over the driver's
tables.  The oracle SQL, when there is one, computes the same columns in
DuckDB over the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` as query ``name`` with optional oracle ``sql``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from spindle.plans import (  # noqa: F401
        q_relational, q_features, q_learners, q_evaluate, q_tune, q_jobs,
    )
