"""Registered queries: name -> (Spark builder(spark, sf_dir), DuckDB oracle SQL or None).

Every query reads the driver tables (through the trace mapping or directly) over the whole
table; nothing is subset to keep the comparison cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    # Importing the modules registers their queries.
    from minutewise.plans import q_minutes, q_profile, q_windows, q_forecast, q_rawtrace, q_io  # noqa: F401
    return REGISTRY
