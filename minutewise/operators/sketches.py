"""Mergeable distinct counts (V3, A4 at scale): stored sketches that roll up.

Exact distinct counts (``profile.function_statistics``) are the default, but cannot be added up: those of a day do not
follow from those of its minutes. ``entity_sketches`` reads the trace once and keeps a HyperLogLog sketch of pods and of
users for each minute, region and function; any coarser table is a union of stored sketches, without the trace.

The relative standard error of an estimate is about 1.04 / sqrt(2^lg_k), 0.8 % at the default, however often sketches
are merged; counts below about 2^lg_k / 8 are nearly exact. A sketch has at most 2^lg_k / 2 bytes, a small one a few.
NULL pods and users are not counted; NULL regions and functions are groups of their own; an empty trace has no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.operators.minutes import minute_of

LG_K = 14
_SKETCHES = ["pods_sketch", "users_sketch"]


def entity_sketches(trace: DataFrame, bucket_seconds: int = 60, time_col: str = "time_worker", lg_k: int = LG_K) -> DataFrame:
    """minute, region, funcName, requests and the sketches of pods and users: the table to store and to append to.

    Sketches are built map-side, so a hot function sends one sketch a task and minute, not its requests."""
    return trace.groupBy(minute_of(time_col, bucket_seconds).alias("minute"), "region", "funcName").agg(
        F.count(F.lit(1)).alias("requests"),
        F.hll_sketch_agg("podID", lg_k).alias("pods_sketch"), F.hll_sketch_agg("userID", lg_k).alias("users_sketch"))


def merge_sketches(sketches: DataFrame, *by) -> DataFrame:
    """The same kind of table for coarser groups (columns or expressions): rolled up again at will."""
    return sketches.groupBy(*by).agg(F.sum("requests").alias("requests"), *[F.hll_union_agg(c).alias(c) for c in _SKETCHES])


def estimated_entities(sketches: DataFrame, *by) -> DataFrame:
    """Requests (exact) and estimated distinct pods and users for each group of ``by``; without ``by`` one row."""
    merged = merge_sketches(sketches, *by)
    return merged.select(*[c for c in merged.columns if c not in _SKETCHES],
                         F.hll_sketch_estimate("pods_sketch").alias("pods"), F.hll_sketch_estimate("users_sketch").alias("users"))
