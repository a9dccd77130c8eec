"""Registry of the checked queries: one Spark plan and one DuckDB oracle each.

Each query reads the driver tables at ``sf_dir`` (through the fixture views)
and runs a library operator over the whole table. Columns are aliased to the
same names on both sides; floats are rounded, arrays are compared through
sizes and elements, so the driver's value hash is engine-neutral.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusprep.plans.oracle import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, views=(), sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` as query ``name`` with its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(views, sql, "duckdb")
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from corpusprep.plans import queries_core, queries_io, queries_media  # noqa: F401
