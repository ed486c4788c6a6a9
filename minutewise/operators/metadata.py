"""Per-group statistics and the two classification rules (volume category, stability)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutewise.operators.selection import quantile_array
from minutewise.schema import KEY
from minutewise.session import materialize


def group_statistics(dense: DataFrame) -> DataFrame:
    """totals and means per group over the dense series (zero minutes included).

    The dense table comes out of the group-partitioned calendar, so this aggregate reuses
    that partitioning and does not shuffle.
    """
    return dense.groupBy(*KEY).agg(
        F.sum("requests").cast("long").alias("total_requests"),
        F.avg("avg_cpu").alias("avg_cpu"),
        F.avg("avg_memory").alias("avg_memory"),
        F.avg("avg_runtime").alias("avg_runtime"),
        F.stddev_samp("requests").alias("std_requests"),
        F.avg("requests").alias("mean_requests"),
    )


def total_quantiles(stats: DataFrame, total_col: str = "total_requests", hot_q: float = 0.80,
                    rare_q: float = 0.25) -> Column:
    """[q_hot, q_rare] of group totals, linear interpolation, as literals found by counting passes over ``stats``
    (pass a stored table): no task holds the totals of all groups.
    """
    return quantile_array(stats, total_col, [hot_q, rare_q])


def group_totals(minutes: DataFrame) -> DataFrame:
    """Total requests per group; equal on the sparse and the dense table."""
    return minutes.groupBy(*KEY).agg(F.sum("requests").cast("long").alias("total_requests"))


def volume_category(stats: DataFrame, total_col: str = "total_requests", hot_q: float = 0.80,
                    rare_q: float = 0.25) -> Column:
    """Hot when total ≥ q80 (tested first), Rare when ≤ q25, else Normal.

    Both quantiles (linear interpolation) come from counting passes over the group table.
    """
    q = total_quantiles(stats, total_col, hot_q, rare_q)
    t = F.col(total_col)
    return (F.when(t >= q[0], "Hot").when(t <= q[1], "Rare").otherwise("Normal"))


def stability_rule(std_col: str = "std_requests", mean_col: str = "mean_requests") -> Column:
    """F8: mean 0 → Noisy; std/mean > 1 → Noisy; else Stable (a NULL std gives Stable)."""
    mean, std = F.col(mean_col), F.col(std_col)
    return (F.when(mean == 0, "Noisy")
            .when(std / mean > 1, "Noisy")
            .otherwise("Stable"))


def function_metadata(dense: DataFrame) -> DataFrame:
    """One row per group with category and stability."""
    stats = materialize(group_statistics(dense))
    return stats.select("*", volume_category(stats).alias("category"), stability_rule().alias("stability"))


def category_counts(metadata: DataFrame) -> DataFrame:
    """F9 (a)."""
    return metadata.groupBy("category").agg(F.count(F.lit(1)).alias("n_groups"))


def stability_counts(metadata: DataFrame) -> DataFrame:
    """F9 (b)."""
    return metadata.groupBy("stability").agg(F.count(F.lit(1)).alias("n_groups"))
