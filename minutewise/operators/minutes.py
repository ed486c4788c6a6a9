"""Minute aggregation and the dense zero-filled calendar (one regular series per group).

Plan shape at scale: raw requests are reduced once, with map-side partial aggregation, to cells
(minute, group, pod, user), and the cells to minutes: exact distinct counts expand cells, not raw
requests. As many cells cross the network as there are combinations in a map task; everything after that is keyed by the
group only, and the dense calendar is generated inside the group partitioning (no join, no
second shuffle of the dense rows), which is exactly what the rolling windows need next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutewise.schema import KEY

SPARSE_VALUE_COLUMNS = ["requests", "avg_cpu", "avg_memory", "avg_runtime", "avg_request_size",
                        "active_pods", "active_users"]
COUNT_COLUMNS = {"requests", "active_pods", "active_users"}


def minute_of(time_col: str | Column = "time_worker", bucket_seconds: int = 60) -> Column:
    """Bucket number of a time in seconds: CAST(FLOOR(t / bucket) AS INT)."""
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    return F.floor(t / F.lit(float(bucket_seconds))).cast("int")


def minute_aggregate(trace: DataFrame, bucket_seconds: int = 60, time_col: str = "time_worker",
                     approx_distinct: float | None = None) -> DataFrame:
    """one row per (minute, region, clusterName, funcName) that has at least one request.

    ``approx_distinct`` switches the two exact distinct counts to HyperLogLog++ with that
    relative error (removes the Expand of exact distinct when pods per minute are huge).
    """
    minutes = trace.withColumn("minute", minute_of(time_col, bucket_seconds))
    means = {"avg_cpu": "cpu_usage", "avg_memory": "memory_usage", "avg_runtime": "runtimeCost",
             "avg_request_size": "requestBodySize"}
    if approx_distinct is not None:
        return minutes.groupBy("minute", *KEY).agg(
            F.count(F.lit(1)).alias("requests"), *[F.avg(c).alias(a) for a, c in means.items()],
            F.approx_count_distinct("podID", approx_distinct).alias("active_pods"),
            F.approx_count_distinct("userID", approx_distinct).alias("active_users"))
    cells = request_cells(minutes, ["minute", *KEY, "podID", "userID"], list(means.values()))
    return cells.groupBy("minute", *KEY).agg(
        F.sum("_n").alias("requests"), *[cell_mean(c).alias(a) for a, c in means.items()],
        F.countDistinct("podID").cast("long").alias("active_pods"),
        F.countDistinct("userID").cast("long").alias("active_users"))


def request_cells(trace: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Raw requests reduced to one row per combination of ``keys``: ``_n`` rows, and for each value the sum
    and the number of rows that have it."""
    return trace.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in values],
        *[F.count(c).alias(f"_n_{c}") for c in values])


def cell_mean(value: str) -> Column:
    """The mean of a value over the requests of some cells (NULL if none has it)."""
    return F.sum(f"_sum_{value}") / F.nullif(F.sum(f"_n_{value}"), F.lit(0))


def minute_bounds(minutes: DataFrame) -> DataFrame:
    """global first and last minute (one row)."""
    return minutes.agg(F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute"))


def function_groups(minutes: DataFrame) -> DataFrame:
    """distinct group keys."""
    return minutes.select(*KEY).distinct()


def minute_calendar(minutes: DataFrame) -> DataFrame:
    """every minute from the global first to the global last, inclusive."""
    b = minute_bounds(minutes)
    return b.select(F.explode(F.sequence("first_minute", "last_minute")).alias("minute"))


def _scalar(df: DataFrame) -> Column:
    """An uncorrelated scalar subquery (planned once, its exchange reused by the main plan)."""
    return df.scalar()


def dense_partitions(sparse: DataFrame, rows_per_partition: int = 2_000_000) -> int:
    """Partition count for the dense calendar, sized from its exact future row count.

    rows = groups × (last − first + 1) is known from one small aggregate of the sparse table
    (pass a materialised sparse table, or give ``partitions`` to ``dense_calendar``);
    the count is at least the session's shuffle partitions and at most the number of groups
    (the exchange is by group, so more partitions than groups would stay empty).
    """
    st = sparse.agg(F.count_distinct(F.struct(*KEY)).alias("g"), F.min("minute").alias("lo"),
                    F.max("minute").alias("hi")).first()
    base = int(sparse.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not st["g"]:
        return base
    rows = st["g"] * (st["hi"] - st["lo"] + 1)
    return int(max(1, min(st["g"], max(base, -(-rows // rows_per_partition)))))


def dense_calendar(sparse: DataFrame, partitions: int | None = None) -> DataFrame:
    """every group × every minute of the global span; absent minutes are zero demand.

    Gap filling inside the group partitioning: each observed row emits the zero minutes between
    the previous observed minute and itself (the first row from the global first minute), and
    the last row of a group also emits the trailing zeros up to the global last minute. Rows per
    group equal the calendar length, so a hot function costs no more than an idle one here.
    NULL key values form their own group (window partitioning is null-safe), so no counts are lost.

    The group exchange is an explicit ``repartition(partitions, K)``: the calendar multiplies
    rows after the exchange, so partitions are sized for the dense output (``dense_partitions``,
    about 2M dense rows each), not coalesced by AQE to the size of the sparse input.
    """
    first = _scalar(sparse.select(F.min("minute")))
    last = _scalar(sparse.select(F.max("minute")))
    n = partitions or dense_partitions(sparse)
    sparse = sparse.repartition(n, *KEY)
    w = Window.partitionBy(*KEY).orderBy("minute")
    prev = F.lag("minute").over(w)
    nxt = F.lead("minute").over(w)
    spans = sparse.select(
        *KEY, "minute", *SPARSE_VALUE_COLUMNS,
        F.coalesce(prev + 1, first).alias("_from"),
        F.when(nxt.isNull(), last).otherwise(F.col("minute")).alias("_to"),
    )
    filled = spans.select(*KEY, "minute", *SPARSE_VALUE_COLUMNS,
                          F.explode(F.sequence("_from", "_to")).alias("_m"))
    observed = F.col("_m") == F.col("minute")
    values = []
    for c in SPARSE_VALUE_COLUMNS:
        zero = F.lit(0).cast("long") if c in COUNT_COLUMNS else F.lit(0.0)
        values.append(F.when(observed, F.coalesce(F.col(c), zero)).otherwise(zero).alias(c))
    return filled.select(*KEY, F.col("_m").cast("int").alias("minute"), *values)


def dense_from_trace(trace: DataFrame, bucket_seconds: int = 60) -> DataFrame:
    """F1 → checkpoint → F5: raw requests are read once."""
    from minutewise.session import materialize
    return dense_calendar(materialize(minute_aggregate(trace, bucket_seconds)))
