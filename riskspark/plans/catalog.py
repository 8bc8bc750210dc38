"""Registered queries: name -> (Spark builder, optional DuckDB SQL oracle).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables (or tables Spark derives from them). Float outputs are
rounded to 6 places in both engines; computed columns carry the same alias in
both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
NOTES: dict[str, str] = {}


def query(name: str, sql: str | None = None, note: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        if note:
            NOTES[name] = note
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from riskspark.plans import (  # noqa: F401
        q_bundle, q_checks, q_clean, q_metrics, q_drift, q_prep, q_models, q_registry, q_windows,
    )
    register_late()


def register_late() -> None:
    """Queries whose oracle is composed from other oracles."""
    from riskspark.plans import q_drift
    if "alert" not in QUERIES:
        query("alert", sql=q_drift._alert_sql())(q_drift.alert_row)
