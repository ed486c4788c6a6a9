"""The descriptive report as one long DataFrame (section, metric, value) and a text sink.

The raw trace is read once into exact cells (see ``trace_cells``); every section is a small
aggregate of those cells. Only the finished report (tens of rows) is written, by one task, as
text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.operators import profile as prof
from minutewise.operators import skew


def _long(df: DataFrame, section: str, metric_col: str | None = None, value_col: str | None = None) -> DataFrame:
    if metric_col is None:  # one wide row → one line per column
        pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns]
        out = df.select(F.inline(F.array(*pairs)))
    else:
        out = df.select(F.col(metric_col).cast("string").alias("metric"), F.col(value_col).cast("double").alias("value"))
    return out.select(F.lit(section).alias("section"), "metric", "value")


def trace_cells(trace: DataFrame, bucket_seconds: int = 60, time_col: str = "time_worker") -> DataFrame:
    """One exact pass over raw requests: per (minute, region, cluster, function, pod, user) the
    request count, per-column sums and non-null counts (for exact means), and min/max time.
    Every report section is an aggregate of these cells, so the trace is read once."""
    from minutewise.operators.minutes import minute_of
    keys = [minute_of(time_col, bucket_seconds).alias("minute"), "region", "clusterName", "funcName",
            "podID", "userID"]
    aggs = [F.count(F.lit(1)).alias("n"), F.min(time_col).alias("t_min"), F.max(time_col).alias("t_max")]
    for c in ("cpu_usage", "memory_usage", "runtimeCost"):
        aggs += [F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
    return trace.groupBy(*keys).agg(*aggs)


def _mean(c: str):
    return F.sum(f"s_{c}") / F.sum(f"n_{c}")


def report(trace: DataFrame) -> DataFrame:
    from minutewise.session import materialize
    cells = materialize(trace_cells(trace))
    requests = F.sum("n").cast("long")
    summary = cells.agg(
        requests.alias("Requests"), F.countDistinct("funcName").alias("Functions"),
        F.countDistinct("userID").alias("Users"), F.countDistinct("podID").alias("Pods"),
        F.countDistinct("clusterName").alias("Clusters"), F.countDistinct("region").alias("Regions"),
        _mean("cpu_usage").alias("Average CPU"), _mean("memory_usage").alias("Average Memory"),
        _mean("runtimeCost").alias("Average Runtime"), F.min("t_min").alias("Start Time"),
        F.max("t_max").alias("End Time"))
    regions = cells.groupBy("region").agg(requests.alias("requests"))
    # the per-function table feeds four sections; computed once (one row per function)
    functions = materialize(cells.groupBy("funcName").agg(
        requests.alias("invocations"), F.countDistinct("podID").alias("pods"),
        F.countDistinct("userID").alias("users"), _mean("cpu_usage").alias("avg_cpu"),
        _mean("memory_usage").alias("avg_memory"), _mean("runtimeCost").alias("avg_runtime")))
    per_minute = cells.groupBy("minute").agg(requests.alias("requests"))
    per_func_minute = cells.groupBy("funcName", "minute").agg(requests.alias("requests"))
    variation = materialize(per_func_minute.groupBy("funcName").agg(
        (F.stddev_samp("requests") / F.avg("requests")).alias("cv")))
    classified = skew.invocation_category(functions)
    ratios = skew.reuse_ratios(functions)
    parts = [
        _long(summary, "DATASET SUMMARY"),
        _long(regions, "REGION REQUESTS", "region", "requests"),
        _long(skew.category_counts(classified), "FUNCTION CLASSIFICATION", "category", "n_functions"),
        _long(skew.reuse_summary(ratios), "FUNCTION REUSE"),
        _long(skew.workload_skew(functions), "WORKLOAD SKEW"),
        _long(prof.peak_requests_per_minute(per_minute), "TEMPORAL HOTSPOTS"),
        _long(skew.stability_counts(skew.stability_by_median(variation)), "STABLE VS NOISY", "stability",
              "n_functions"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_report_text(rep: DataFrame, path: str) -> None:
    """One text file, lines ``section | metric: value`` (the report is a few dozen rows)."""
    line = F.format_string("%s | %s: %s", "section", "metric", F.col("value").cast("string"))
    rep.select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)
