"""Registry of the queries run on the driver's tables and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the DuckDB oracle (omit for a rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def render(c: str | Column, sep: str = ", ") -> Column:
    """Array -> text for the oracle comparison (the library keeps arrays)."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, sep)


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from catalogprep.plans import (  # noqa: F401
        q_catalog, q_features, q_io, q_profile, q_quality, q_stats, q_text,
    )
