"""Per-minute aggregation of a request stream with a watermark.

Event time is ``time_worker`` seconds; rows later than the watermark are dropped by Spark and
counted in the query progress (``numRowsDroppedByWatermark``). ``watermarked_minutes`` is exact in every
column: it chains two stateful aggregations and emits a minute once, when it is closed. ``streaming_minute_aggregate``
shows open minutes too, in update mode, at the price of its distinct counts: a single streaming aggregation has no
exact ones, so pods/users use HyperLogLog++ (``approx_count_distinct``)
at Spark's default 5 % relative error: its sketch (2^9 registers) is part of every state row, and
at 1 % (2^14 registers) the state store writes grow about 30×.
Each trigger emits updated groups (update mode) through ``foreachBatch`` under its
``batch_id``; the latest version of each (minute, group) is the result — idempotent on retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minutewise.schema import KEY

#: Files of a micro-batch at most, so that the first one does not take the whole backlog.
MAX_FILES = 1000


def streaming_minute_aggregate(stream: DataFrame, watermark: str = "10 minutes", bucket: str = "1 minute",
                               approx_rsd: float = 0.05) -> DataFrame:
    ev = stream.withColumn("event_time", F.timestamp_seconds(F.col("time_worker")))
    agg = (ev.withWatermark("event_time", watermark)
           .groupBy(F.window("event_time", bucket).alias("w"), *KEY)
           .agg(F.count(F.lit(1)).alias("requests"),
                F.avg("cpu_usage").alias("avg_cpu"),
                F.avg("memory_usage").alias("avg_memory"),
                F.avg("runtimeCost").alias("avg_runtime"),
                F.avg("requestBodySize").alias("avg_request_size"),
                F.approx_count_distinct("podID", approx_rsd).alias("active_pods"),
                F.approx_count_distinct("userID", approx_rsd).alias("active_users")))
    minute = F.floor(F.unix_micros(F.col("w.start")) / F.lit(60_000_000)).cast("int")
    return agg.select(minute.alias("minute"), *KEY, "requests", "avg_cpu", "avg_memory", "avg_runtime",
                      "avg_request_size", F.col("active_pods").cast("long"), F.col("active_users").cast("long"))


def run_minute_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, schema,
                      watermark: str = "10 minutes", max_files_per_trigger: int = MAX_FILES) -> dict:
    """Run the aggregation over the parquet files in ``source_dir`` until caught up; returns the number of
    batches and of partial rows dropped as late, over all triggers."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    agg = streaming_minute_aggregate(reader.parquet(source_dir), watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    q = (agg.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    # Spark keeps the last hundred progress records only, so they are gathered while the query runs
    dropped: dict[int, int] = {}
    while not q.awaitTermination(0.5):
        _count_dropped(q, dropped)
    _count_dropped(q, dropped)
    return {"batches": len(dropped), "rows_dropped_by_watermark": sum(dropped.values())}


def _count_dropped(query, dropped: dict[int, int]) -> None:
    """Rows dropped as late, by batch."""
    for p in query.recentProgress:
        get = p.get if isinstance(p, dict) else lambda k, p=p: getattr(p, k)
        ops = get("stateOperators")
        dropped[get("batchId")] = sum(int(o["numRowsDroppedByWatermark"] if isinstance(o, dict) else o.numRowsDroppedByWatermark)
                                      for o in ops)


def latest_minutes(out: DataFrame) -> DataFrame:
    """Final table of an update-mode run: the row of the latest batch per (minute, group)."""
    w = Window.partitionBy("minute", *KEY).orderBy(F.desc("batch_id"))
    return out.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch_id")


# ---- exact variant: per-batch partial cells + distinct key rows, merged by a batch job --------

MEAN_SOURCES = {"avg_cpu": "cpu_usage", "avg_memory": "memory_usage", "avg_runtime": "runtimeCost",
                "avg_request_size": "requestBodySize"}


def _exact_batch_writer(out_path: str, bucket_seconds: int):
    from minutewise.operators.minutes import minute_of

    def write(batch: DataFrame, batch_id: int) -> None:
        m = batch.withColumn("minute", minute_of("time_worker", bucket_seconds))
        aggs = [F.count(F.lit(1)).alias("n")]
        for src in MEAN_SOURCES.values():
            aggs += [F.sum(src).alias(f"s_{src}"), F.count(src).alias(f"c_{src}")]
        parts = {
            "cells": m.groupBy("minute", *KEY).agg(*aggs),
            "pods": m.select("minute", *KEY, "podID").where(F.col("podID").isNotNull()).distinct(),
            "users": m.select("minute", *KEY, "userID").where(F.col("userID").isNotNull()).distinct(),
        }
        for name, df in parts.items():
            (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out_path}/{name}"))
    return write


def run_exact_minute_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, schema,
                            bucket_seconds: int = 60, max_files_per_trigger: int | None = None) -> None:
    """X2 (exact): each micro-batch appends exact partial cells and distinct (minute, group, pod)
    / (minute, group, user) rows under its batch id (idempotent on retry); ``exact_minutes``
    merges them. No sets are held per group and no streaming state is kept; late rows are
    merged like any other (there is no watermark cut in this variant)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source_dir).writeStream.foreachBatch(_exact_batch_writer(out_path, bucket_seconds))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def exact_minutes(spark: SparkSession, out_path: str) -> DataFrame:
    """Merge the per-batch parts into the exact minute aggregate (F1 columns)."""
    cells = spark.read.parquet(f"{out_path}/cells")
    sums = [F.sum("n").alias("requests")]
    for dst, src in MEAN_SOURCES.items():
        sums.append((F.sum(f"s_{src}") / F.sum(f"c_{src}")).alias(dst))
    keys = ["minute", *KEY]
    merged = cells.groupBy(*keys).agg(*sums)
    pods = spark.read.parquet(f"{out_path}/pods").groupBy(*keys).agg(F.countDistinct("podID").alias("active_pods"))
    users = spark.read.parquet(f"{out_path}/users").groupBy(*keys).agg(F.countDistinct("userID").alias("active_users"))
    # each column is in one of the three, so a union and one aggregate put the rows of a key together
    parts = merged.unionByName(pods, allowMissingColumns=True).unionByName(users, allowMissingColumns=True)
    out = parts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in parts.columns if c not in keys])
    return out.select("minute", *KEY, F.col("requests").cast("long"), *MEAN_SOURCES,
                      F.coalesce("active_pods", F.lit(0)).cast("long").alias("active_pods"),
                      F.coalesce("active_users", F.lit(0)).cast("long").alias("active_users"))


# ---- exact variant under a watermark: chained stateful aggregations in append mode ---------------

#: funcName of the row that ends a replayed stream (``end_of_stream``).
END = "\x00end"
_COUNTED = {"pod": "podID", "user": "userID"}


def watermarked_minutes(stream: DataFrame, watermark: str = "10 minutes", bucket: str = "1 minute") -> DataFrame:
    """F1 exactly, as a stream: a minute is emitted once, when the watermark has passed its end.

    Streaming aggregation has no exact distinct count, so there are two stateful aggregations in a chain. The first
    keeps one row for each (minute, group), with the sums, one for each pod in it and one for each user: a
    de-duplication whose state is that of the open minutes only and is spread by pod and user, so a hot function is no
    hot key. The second counts the pods and users of the closed minutes and puts them beside the sums.
    """
    ev = stream.withColumn("event_time", F.timestamp_seconds(F.col("time_worker"))).withWatermark("event_time", watermark)
    # with the event time in it, so that the filter is not moved below the watermark that the last row advances
    ev = ev.where(~(F.col("funcName").eqNullSafe(F.lit(END)) & F.col("event_time").isNotNull()))
    who = [F.struct(F.lit("all").alias("kind"), F.lit(None).cast("string").alias("who"))]
    who += [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("who")) for k, c in _COUNTED.items()]
    rows = ev.select("event_time", *KEY, *MEAN_SOURCES.values(), F.explode(F.array(*who)).alias("e"))
    sums = F.col("e.kind") == "all"
    parts = [F.count(F.lit(1)).alias("n")]
    for src in MEAN_SOURCES.values():
        parts += [F.sum(F.when(sums, F.col(src))).alias(f"s_{src}"), F.count(F.when(sums, F.col(src))).alias(f"c_{src}")]
    cells = (rows.groupBy(F.window("event_time", bucket), *KEY, F.col("e.kind").alias("kind"), F.col("e.who").alias("who"))
             .agg(*parts))
    means = [(F.sum(f"s_{src}") / F.nullif(F.sum(f"c_{src}"), F.lit(0))).alias(dst) for dst, src in MEAN_SOURCES.items()]
    closed = cells.groupBy(F.window("window", bucket), *KEY).agg(
        F.sum(F.when(F.col("kind") == "all", F.col("n"))).alias("requests"), *means,
        *[F.count_if((F.col("kind") == k) & F.col("who").isNotNull()).cast("long").alias(f"active_{k}s") for k in _COUNTED])
    minute = F.floor(F.unix_micros(F.col("window.start")) / F.lit(60_000_000)).cast("int")
    return closed.select(minute.alias("minute"), *KEY, "requests", *MEAN_SOURCES, "active_pods", "active_users")


CLOSED_SCHEMA = ("minute int, region string, clusterName string, funcName string, requests long, avg_cpu double, avg_memory double, "
                 "avg_runtime double, avg_request_size double, active_pods long, active_users long")


def run_watermarked_minutes(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, schema,
                            watermark: str = "10 minutes", max_files_per_trigger: int = MAX_FILES) -> dict:
    """Take all files in ``source_dir`` not seen by ``checkpoint`` and append the minutes that close to ``out_path``
    (the file sink's log makes that once only). Returns the batches, and the rows dropped as late: partial rows of the
    first aggregation, so up to one for the sums, the pod and the user of a late request."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    q = (watermarked_minutes(reader.parquet(source_dir), watermark).writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    dropped: dict[int, int] = {}
    while not q.awaitTermination(0.5):
        _count_dropped(q, dropped)
    _count_dropped(q, dropped)
    return {"batches": len(dropped), "rows_dropped_by_watermark": sum(dropped.values())}


def closed_minutes(spark: SparkSession, out_path: str) -> DataFrame:
    """The minutes that ``run_watermarked_minutes`` has emitted so far."""
    return spark.read.schema(CLOSED_SCHEMA).parquet(out_path)


def end_of_stream(spark: SparkSession, schema, after: float, watermark_seconds: float = 600.0, bucket_seconds: float = 60.0) -> DataFrame:
    """One row, to be added to the source after its last file: its time moves the watermark past every minute up to
    ``after`` (seconds), so that all of them close. It is no request itself. Requests that come later are late."""
    time = F.lit(float(after) + watermark_seconds + 2 * bucket_seconds)
    row = {"time_worker": time, "funcName": F.lit(END)}
    return spark.range(1).select(*[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
