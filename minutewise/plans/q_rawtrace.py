"""Registered queries: the raw-trace variant (G1–G13) on the driver trace."""

from __future__ import annotations

from pyspark.sql import functions as F

from minutewise.functions.numeric import round_doubles
from minutewise.operators import rawtrace as raw
from minutewise.plans.oracle_sql import features_cte, r, with_ctes
from minutewise.plans.registry import register
from minutewise.schema import COST_COLUMNS, KEY
from minutewise.sources.fixture import trace

K = ", ".join(KEY)
COSTS_SQL = ", ".join(f"CAST(0.0 AS DOUBLE) AS {c}" for c in COST_COLUMNS.values())
RAW_AGG_CTE = f"""rt AS (SELECT *, time_worker AS ts FROM trace),
rmin AS (SELECT MIN(ts) AS t0 FROM rt),
ragg AS (
  SELECT CAST(FLOOR((ts - t0) / 60) AS INTEGER) AS minute, {K}, CAST(COUNT(*) AS BIGINT) AS requests,
         AVG(cpu_usage) AS avg_cpu, AVG(memory_usage) AS avg_memory, AVG(runtimeCost) AS avg_runtime,
         AVG(requestBodySize) AS avg_request_size, CAST(COUNT(DISTINCT podID) AS BIGINT) AS active_pods,
         CAST(COUNT(DISTINCT userID) AS BIGINT) AS active_users, {COSTS_SQL}
  FROM rt, rmin GROUP BY ALL
)"""
KEPT_CTE = f"""kept AS (SELECT * EXCLUDE (gn) FROM (SELECT *, COUNT(*) OVER (PARTITION BY {K}) AS gn FROM ragg) WHERE gn >= 70)"""
CODES_CTE = """ftot AS (SELECT funcName, SUM(requests) AS total FROM kept GROUP BY funcName),
fq AS (SELECT quantile_cont(total, 0.8) AS qh, quantile_cont(total, 0.25) AS qr FROM ftot),
fcat AS (SELECT funcName, CASE WHEN total >= qh THEN 2 WHEN total <= qr THEN 0 ELSE 1 END AS category FROM ftot, fq),
fstab AS (
  SELECT funcName,
         CASE WHEN COALESCE(COALESCE(STDDEV_SAMP(requests), 0.0) / NULLIF(AVG(requests), 0.0), 0.0) <= 1.0
              THEN 0 ELSE 1 END AS stability
  FROM kept GROUP BY funcName
)"""

RAW_NUM = ["avg_cpu", "avg_memory", "avg_runtime", "avg_request_size", "rolling_mean_5", "rolling_mean_15",
           "rolling_mean_30", "rolling_std", "rolling_median", "warm_capacity", "growth_rate", "coeff_variation",
           "cpu_per_request", "memory_per_request", "runtime_per_request", "warm_ratio", "hour_sin", "hour_cos",
           "minute_sin", "minute_cos", *COST_COLUMNS.values()]
RAW_PLAIN = [*KEY, "minute", "requests", "active_pods", "active_users", "lag_1", "lag_5", "lag_15", "lag_30",
             "rolling_max", "rolling_min", "trend", "minute_of_hour", "hour_of_day", "category", "stability"]


@register("raw_trace_features", with_ctes(
    RAW_AGG_CTE, KEPT_CTE, features_cte(src="kept", meta=None, std="STDDEV_POP", zero_div="zero"), CODES_CTE,
    select=f"""SELECT {", ".join(c for c in RAW_PLAIN if c not in ("category", "stability"))},
  c.category, s.stability, {", ".join(f"{r('f.' + c)} AS {c}" for c in RAW_NUM)}
FROM feat f LEFT JOIN fcat c USING (funcName) LEFT JOIN fstab s USING (funcName)"""))
def q_raw_trace_features(spark, sf):
    f = raw.raw_feature_frame(trace(spark, sf))
    return round_doubles(f.select(*RAW_PLAIN, *RAW_NUM))


@register("raw_minute_aggregate", with_ctes(RAW_AGG_CTE, select=
          f"SELECT minute, {K}, requests, active_pods, active_users, "
          + ", ".join(f"{r(c)} AS {c}" for c in ["avg_cpu", "avg_memory", "avg_runtime", "avg_request_size",
                                                 *COST_COLUMNS.values()]) + " FROM ragg"))
def q_raw_minute_aggregate(spark, sf):
    df, probe = raw.with_time(trace(spark, sf))
    df = raw.relative_minute(df, start=probe.start)
    return round_doubles(raw.raw_minute_aggregate(df))


@register("raw_minute_aggregate_fallbacks", with_ctes(select=f"""
SELECT CAST(FLOOR((time_worker - (SELECT MIN(time_worker) FROM trace)) / 60) AS INTEGER) AS minute, {K},
       CAST(COUNT(*) AS BIGINT) AS requests, CAST(1.0 AS DOUBLE) AS avg_cpu, CAST(1.0 AS DOUBLE) AS avg_memory,
       {r("AVG(runtimeCost)")} AS avg_runtime, CAST(1.0 AS DOUBLE) AS avg_request_size,
       CAST(COUNT(*) AS BIGINT) AS active_pods, CAST(COUNT(DISTINCT userID) AS BIGINT) AS active_users, {COSTS_SQL}
FROM trace GROUP BY ALL"""))
def q_raw_minute_aggregate_fallbacks(spark, sf):
    """G5 with cpu/memory/request size and podID absent from the input."""
    t = trace(spark, sf).drop("cpu_usage", "memory_usage", "requestBodySize", "podID")
    df, probe = raw.with_time(t)
    return round_doubles(raw.raw_minute_aggregate(raw.relative_minute(df, start=probe.start)))


@register("time_unit_detection", with_ctes(select=f"""
SELECT {r('MIN(t)')} AS min_seconds, {r('MAX(t)')} AS max_seconds, CAST(COUNT(t) AS BIGINT) AS n_parsed FROM (
  SELECT CAST(epoch_us(ts) AS DOUBLE) / 1000000.0 AS t FROM events)"""))
def q_time_unit_detection(spark, sf):
    """G1 on event times given as integer microseconds (detected as µs by magnitude)."""
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    us = ev.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"))
    s = raw.to_seconds(us, "t_us", "t")
    return round_doubles(s.agg(F.min("t").alias("min_seconds"), F.max("t").alias("max_seconds"),
                               F.count("t").alias("n_parsed")))


@register("time_text_parsing", with_ctes(select=f"""
SELECT {r('MIN(t)')} AS min_seconds, {r('MAX(t)')} AS max_seconds, CAST(COUNT(t) AS BIGINT) AS n_parsed FROM (
  SELECT CAST(epoch_us(ts) AS DOUBLE) / 1000000.0 AS t FROM events)"""))
def q_time_text_parsing(spark, sf):
    """G1 on ISO date-time text (no value numeric → parsed as timestamps)."""
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    txt = ev.select(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t_txt"))
    s = raw.to_seconds(txt, "t_txt", "t")
    return round_doubles(s.agg(F.min("t").alias("min_seconds"), F.max("t").alias("max_seconds"),
                               F.count("t").alias("n_parsed")))


@register("function_codes", with_ctes(RAW_AGG_CTE, KEPT_CTE, CODES_CTE, select=
          "SELECT c.funcName, c.category, s.stability FROM fcat c JOIN fstab s USING (funcName)"))
def q_function_codes(spark, sf):
    from minutewise.operators.features import drop_short_groups
    from minutewise.session import stored
    df, probe = raw.with_time(trace(spark, sf))
    minutes = stored(raw.raw_minute_aggregate(raw.relative_minute(df, start=probe.start)), "raw-minutes")
    kept = drop_short_groups(minutes, 70)
    return raw.function_category_codes(kept).join(raw.function_stability_codes(kept), "funcName")


@register("filled_time_minutes", with_ctes(f"""gaps AS (
  SELECT event_id,
    'R' || CAST(user_id % 5 + 1 AS VARCHAR) AS region,
    'c' || CAST((user_id % 5) % 4 AS VARCHAR) AS clusterName,
    'f' || CAST(CAST(least(floor(value / 10), 49) AS INTEGER) AS VARCHAR) AS funcName,
    CASE WHEN event_type = 'error' THEN NULL
         ELSE 2592000 + (epoch_us(ts) - 1704067200000000) / 1000000 / 30 END AS tw
  FROM events
),
filled AS (
  SELECT *, COALESCE(tw,
      LAST_VALUE(tw IGNORE NULLS) OVER (PARTITION BY region ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      FIRST_VALUE(tw IGNORE NULLS) OVER (PARTITION BY region ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS ts
  FROM gaps
)""", select=f"""
SELECT CAST(FLOOR((ts - (SELECT MIN(ts) FROM filled)) / 60) AS INTEGER) AS minute, {K},
       CAST(COUNT(*) AS BIGINT) AS requests, CAST(COUNT(*) FILTER (WHERE tw IS NULL) AS BIGINT) AS filled_rows
FROM filled GROUP BY ALL"""))
def q_filled_time_minutes(spark, sf):
    """Times of 'error' events treated as unparseable, forward- then backward-filled in
    event order per region (the file stand-in), then counted per relative minute (G4)."""
    from minutewise.sources.fixture import events_as_trace, table
    t = events_as_trace(table(spark, sf, "events"), keep=["event_id", "event_type"])
    t = t.withColumn("tw", F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                     .otherwise(F.col("time_worker")))
    filled = raw.fill_time(t.withColumn("ts", F.col("tw")), "ts", "event_id", ["region"])
    m = raw.relative_minute(filled)
    return m.groupBy("minute", *KEY).agg(F.count(F.lit(1)).alias("requests"),
                                         F.count_if(F.col("tw").isNull()).alias("filled_rows"))


def _filled_sql() -> str:
    costs = ", ".join({"workerCost": "AVG(cpu_usage * 2) AS avg_worker_cost",
                       "totalCost_frontend": "COALESCE(AVG(CASE WHEN event_id % 3 > 0 THEN runtimeCost + 1 END), 0.0) AS avg_total_cost_frontend"}
                      .get(src, f"CAST(0.0 AS DOUBLE) AS {dst}") for src, dst in COST_COLUMNS.items())
    agg = f"""src AS (
  SELECT event_id, 'R' || CAST(user_id % 5 + 1 AS VARCHAR) AS region, 'c' || CAST((user_id % 5) % 4 AS VARCHAR) AS clusterName,
    'f' || CAST(CAST(least(floor(value / 10), 49) AS INTEGER) AS VARCHAR) AS funcName, 'pod' || (props ->> '$.k') AS podID,
    CAST(user_id AS VARCHAR) AS userID, value / 100 AS cpu_usage, CAST(props ->> '$.k' AS DOUBLE) AS memory_usage,
    value / 1000 AS runtimeCost, CAST(length(props) AS DOUBLE) AS requestBodySize,
    CASE WHEN event_type = 'error' THEN NULL ELSE 2592000 + (epoch_us(ts) - 1704067200000000) / 1000000 / 30 END AS tw FROM events),
rt AS (
  SELECT *, COALESCE(tw,
      LAST_VALUE(tw IGNORE NULLS) OVER (PARTITION BY region ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      FIRST_VALUE(tw IGNORE NULLS) OVER (PARTITION BY region ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS ts FROM src),
rmin AS (SELECT MIN(ts) AS t0 FROM rt),
ragg AS (
  SELECT CAST(FLOOR((ts - t0) / 60) AS INTEGER) AS minute, {K}, CAST(COUNT(*) AS BIGINT) AS requests,
         AVG(cpu_usage) AS avg_cpu, AVG(memory_usage) AS avg_memory, AVG(runtimeCost) AS avg_runtime,
         AVG(requestBodySize) AS avg_request_size, CAST(COUNT(DISTINCT podID) AS BIGINT) AS active_pods,
         CAST(COUNT(DISTINCT userID) AS BIGINT) AS active_users, {costs}
  FROM rt, rmin GROUP BY ALL)"""
    nums = ", ".join(f"{r('f.' + c)} AS {c}" for c in RAW_NUM)
    plain = [c for c in RAW_PLAIN if c not in ("category", "stability")]
    return with_ctes(agg, KEPT_CTE.replace(">= 70", ">= 40"),
                     features_cte(src="kept", meta=None, std="STDDEV_POP", zero_div="zero"), CODES_CTE,
                     select=f"SELECT {', '.join(plain)}, c.category, s.stability, {nums} "
                            "FROM feat f LEFT JOIN fcat c USING (funcName) LEFT JOIN fstab s USING (funcName)")


@register("raw_trace_features_filled", _filled_sql())
def q_raw_trace_features_filled(spark, sf):
    """G3 and G6 within the whole raw path: times missing for 'error' events, two cost columns present."""
    from minutewise.sources.fixture import events_as_trace, table
    t = events_as_trace(table(spark, sf, "events"), keep=["event_id", "event_type"])
    t = (t.withColumn("time_worker", F.when(F.col("event_type") != "error", F.col("time_worker")))
         .withColumn("workerCost", F.col("cpu_usage") * 2)
         .withColumn("totalCost_frontend", F.when(F.col("event_id") % 3 > 0, F.col("runtimeCost") + 1)))
    f = raw.raw_feature_frame(t, min_rows=40, fill_order="event_id", fill_parts=["region"])
    return round_doubles(f.select(*RAW_PLAIN, *RAW_NUM))
