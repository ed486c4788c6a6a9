"""Descriptive trace analytics: summary, region and function statistics, reuse, hotspots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.operators.minutes import cell_mean, minute_of

# Fixed output values: the labels of the report's summary section, in order.
SUMMARY_LABELS = ["Requests", "Functions", "Users", "Pods", "Clusters", "Regions", "Average CPU",
                  "Average Memory", "Average Runtime", "Start Time", "End Time"]


def dataset_summary(trace: DataFrame, time_col: str = "time_worker") -> DataFrame:
    """A1 (wide): 11 metrics in one pass over the requests; distinct counts expand cells (combinations of the
    entities), not requests."""
    keys, values = ["funcName", "userID", "podID", "clusterName", "region"], ["cpu_usage", "memory_usage", "runtimeCost"]
    cells = trace.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in values],
        *[F.count(c).alias(f"_n_{c}") for c in values], F.min(time_col).alias("_first"), F.max(time_col).alias("_last"))
    return cells.agg(
        F.sum("_n").alias("requests"),
        F.countDistinct("funcName").alias("functions"),
        F.countDistinct("userID").alias("users"),
        F.countDistinct("podID").alias("pods"),
        F.countDistinct("clusterName").alias("clusters"),
        F.countDistinct("region").alias("regions"),
        cell_mean("cpu_usage").alias("avg_cpu"),
        cell_mean("memory_usage").alias("avg_memory"),
        cell_mean("runtimeCost").alias("avg_runtime"),
        F.min("_first").alias("start_time"),
        F.max("_last").alias("end_time"),
    ).withColumn("requests", F.coalesce("requests", F.lit(0)))


def dataset_summary_long(trace: DataFrame) -> DataFrame:
    """A1 (long): (metric, value) rows in the report's label order, values as DOUBLE."""
    wide = dataset_summary(trace)
    pairs = [F.struct(F.lit(label).alias("metric"), F.col(c).cast("double").alias("value"))
             for label, c in zip(SUMMARY_LABELS, wide.columns)]
    return wide.select(F.inline(F.array(*pairs)))


def region_statistics(trace: DataFrame) -> DataFrame:
    """A2 (A3 is its first two columns): requests and averages per region."""
    return trace.groupBy("region").agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("cpu_usage").alias("avg_cpu"),
        F.avg("memory_usage").alias("avg_memory"),
        F.avg("runtimeCost").alias("avg_runtime"),
    )


def function_statistics(trace: DataFrame) -> DataFrame:
    """A4: per funcName across regions: invocations, distinct pods/users, averages.

    Exact distinct counts are planned with Expand: the distinct keys are shuffled by
    (funcName, pod) / (funcName, user), so one hot function is spread over many tasks.
    """
    return trace.groupBy("funcName").agg(
        F.count(F.lit(1)).alias("invocations"),
        F.countDistinct("podID").alias("pods"),
        F.countDistinct("userID").alias("users"),
        F.avg("cpu_usage").alias("avg_cpu"),
        F.avg("memory_usage").alias("avg_memory"),
        F.avg("runtimeCost").alias("avg_runtime"),
    )


def top_functions(functions: DataFrame, k: int = 20) -> DataFrame:
    """A5: top-k by invocations, ties broken by name (TakeOrderedAndProject)."""
    return functions.orderBy(F.desc("invocations"), F.asc("funcName")).limit(k)


def function_reuse(trace: DataFrame) -> DataFrame:
    """avg/min/max requests per function (aggregate over an aggregate)."""
    per = trace.groupBy("funcName").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.avg("n").alias("avg_requests_per_function"),
                   F.min("n").alias("min_requests_per_function"),
                   F.max("n").alias("max_requests_per_function"))


def pod_reuse(trace: DataFrame) -> DataFrame:
    """Average distinct pods per function."""
    per = trace.groupBy("funcName").agg(F.countDistinct("podID").alias("pods"))
    return per.agg(F.avg("pods").alias("avg_pods_per_function"))


def column_stats(trace: DataFrame, col: str, prefix: str) -> DataFrame:
    """A8 (cpu_usage) / A9 (memory_usage): avg, min, max."""
    return trace.agg(F.avg(col).alias(f"avg_{prefix}"), F.min(col).alias(f"min_{prefix}"),
                     F.max(col).alias(f"max_{prefix}"))


def temporal_hotspots(trace: DataFrame, bucket_seconds: int = 60, time_col: str = "time_worker") -> DataFrame:
    """Per minute: requests, distinct functions and pods, avg cpu/memory."""
    return trace.groupBy(minute_of(time_col, bucket_seconds).alias("minute")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.countDistinct("funcName").alias("active_functions"),
        F.countDistinct("podID").alias("active_pods"),
        F.avg("cpu_usage").alias("avg_cpu"),
        F.avg("memory_usage").alias("avg_memory"),
    )


def peak_requests_per_minute(hotspots: DataFrame) -> DataFrame:
    """A17."""
    return hotspots.agg(F.max("requests").alias("peak_requests_per_minute"))


def function_variation(trace: DataFrame, bucket_seconds: int = 60, time_col: str = "time_worker") -> DataFrame:
    """Per funcName over *active* minutes only: mean, sample std, cv = std/mean."""
    per = trace.groupBy("funcName", minute_of(time_col, bucket_seconds).alias("minute")).agg(
        F.count(F.lit(1)).alias("requests"))
    stats = per.groupBy("funcName").agg(F.avg("requests").alias("mean_requests"),
                                        F.stddev_samp("requests").alias("std_requests"))
    return stats.withColumn("cv", F.col("std_requests") / F.col("mean_requests"))
