"""The standing test trace: the driver's ``events`` table mapped onto the invocation-trace schema.

``events`` covers 30 days; elapsed seconds divided by 30 put it onto one day starting at
2,592,000 s, the shape of the original trace. The mapping is pure column expressions, so the
scan keeps its pushed filters and pruned columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRACE_EPOCH_SECONDS = 2592000
EVENTS_ORIGIN = "2024-01-01 00:00:00"
TIME_COMPRESSION = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _elapsed_seconds(ts: Column) -> Column:
    micros = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'{EVENTS_ORIGIN}', ts)")
    return micros / F.lit(1000000) / F.lit(TIME_COMPRESSION)


def events_as_trace(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Map ``events`` rows to raw invocation records (one row per request); ``keep`` carries
    extra event columns along (e.g. ``event_id`` as a file-order column)."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        *(keep or []),
        (F.lit(TRACE_EPOCH_SECONDS) + _elapsed_seconds(F.col("ts"))).alias("time_worker"),
        F.concat(F.lit("R"), (F.col("user_id") % 5 + 1).cast("string")).alias("region"),
        F.concat(F.lit("c"), ((F.col("user_id") % 5) % 4).cast("string")).alias("clusterName"),
        F.concat(F.lit("f"), F.least(F.floor(F.col("value") / 10), F.lit(49)).cast("int").cast("string"))
        .alias("funcName"),
        F.concat(F.lit("pod"), k).alias("podID"),
        F.col("user_id").cast("string").alias("userID"),
        (F.col("value") / 100).alias("cpu_usage"),
        k.cast("double").alias("memory_usage"),
        (F.col("value") / 1000).alias("runtimeCost"),
        F.length("props").cast("double").alias("requestBodySize"),
    )


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trace derived from ``{sf_dir}/events.parquet``."""
    return events_as_trace(table(spark, sf_dir, "events"))


# DuckDB twin of ``events_as_trace`` for oracle SQL; every oracle inlines it as a CTE.
TRACE_CTE_SQL = """trace AS (
  SELECT
    2592000 + (epoch_us(ts) - 1704067200000000) / 1000000 / 30 AS time_worker,
    'R' || CAST(user_id % 5 + 1 AS VARCHAR) AS region,
    'c' || CAST((user_id % 5) % 4 AS VARCHAR) AS clusterName,
    'f' || CAST(CAST(least(floor(value / 10), 49) AS INTEGER) AS VARCHAR) AS funcName,
    'pod' || (props ->> '$.k') AS podID,
    CAST(user_id AS VARCHAR) AS userID,
    value / 100 AS cpu_usage,
    CAST(props ->> '$.k' AS DOUBLE) AS memory_usage,
    value / 1000 AS runtimeCost,
    CAST(length(props) AS DOUBLE) AS requestBodySize
  FROM events
)"""
