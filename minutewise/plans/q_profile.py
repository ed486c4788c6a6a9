"""Registered queries: descriptive trace analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from minutewise.functions.numeric import round_doubles
from minutewise.operators import profile as prof
from minutewise.operators import sketches, skew
from minutewise.plans.oracle_sql import r, with_ctes
from minutewise.plans.registry import register
from minutewise.session import materialize, stored
from minutewise.sources.fixture import trace

FUNCS_CTE = """funcs AS (
  SELECT funcName, CAST(COUNT(*) AS BIGINT) AS invocations, CAST(COUNT(DISTINCT podID) AS BIGINT) AS pods,
         CAST(COUNT(DISTINCT userID) AS BIGINT) AS users, AVG(cpu_usage) AS avg_cpu,
         AVG(memory_usage) AS avg_memory, AVG(runtimeCost) AS avg_runtime
  FROM trace GROUP BY funcName
)"""
VARIATION_CTE = """per_minute AS (
  SELECT funcName, CAST(FLOOR(time_worker / 60) AS INTEGER) AS minute, COUNT(*) AS requests
  FROM trace GROUP BY 1, 2
),
variation AS (
  SELECT funcName, AVG(requests) AS mean_requests, STDDEV(requests) AS std_requests,
         STDDEV(requests) / AVG(requests) AS cv
  FROM per_minute GROUP BY funcName
)"""


def _funcs(spark, sf):
    return prof.function_statistics(trace(spark, sf))


def _hist_sql(src: str, col: str) -> str:
    return f"""vals AS (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL),
b0 AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM vals),
b AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM b0),
cnt AS (SELECT CAST(LEAST(FLOOR((v - b.lo) / (b.hi - b.lo) * 30) + 1, 30) AS INTEGER) AS bin, COUNT(*) AS n
        FROM vals, b GROUP BY 1)"""


HIST_SELECT = (f"SELECT CAST(g.range AS INTEGER) AS bin, {r('b.lo + (b.hi - b.lo) * (g.range - 1) / 30')} AS lo, "
               f"{r('b.lo + (b.hi - b.lo) * g.range / 30')} AS hi, CAST(COALESCE(cnt.n, 0) AS BIGINT) AS n "
               "FROM b, range(1, 31) g LEFT JOIN cnt ON cnt.bin = g.range")


@register("dataset_summary", with_ctes(select=f"""
SELECT CAST(COUNT(*) AS BIGINT) AS requests, CAST(COUNT(DISTINCT funcName) AS BIGINT) AS functions,
       CAST(COUNT(DISTINCT userID) AS BIGINT) AS users, CAST(COUNT(DISTINCT podID) AS BIGINT) AS pods,
       CAST(COUNT(DISTINCT clusterName) AS BIGINT) AS clusters, CAST(COUNT(DISTINCT region) AS BIGINT) AS regions,
       {r('AVG(cpu_usage)')} AS avg_cpu, {r('AVG(memory_usage)')} AS avg_memory, {r('AVG(runtimeCost)')} AS avg_runtime,
       {r('MIN(time_worker)')} AS start_time, {r('MAX(time_worker)')} AS end_time
FROM trace"""))
def q_dataset_summary(spark, sf):
    return round_doubles(prof.dataset_summary(trace(spark, sf)))


@register("dataset_summary_long", with_ctes(select=f"""
SELECT metric, {r('value')} AS value FROM (
  SELECT COUNT(*) AS "Requests", COUNT(DISTINCT funcName) AS "Functions", COUNT(DISTINCT userID) AS "Users",
         COUNT(DISTINCT podID) AS "Pods", COUNT(DISTINCT clusterName) AS "Clusters",
         COUNT(DISTINCT region) AS "Regions", AVG(cpu_usage) AS "Average CPU", AVG(memory_usage) AS "Average Memory",
         AVG(runtimeCost) AS "Average Runtime", MIN(time_worker) AS "Start Time", MAX(time_worker) AS "End Time"
  FROM trace
) UNPIVOT (value FOR metric IN (COLUMNS(*)))"""))
def q_dataset_summary_long(spark, sf):
    return round_doubles(prof.dataset_summary_long(trace(spark, sf)))


@register("region_statistics", with_ctes(select=f"""
SELECT region, CAST(COUNT(*) AS BIGINT) AS requests, {r('AVG(cpu_usage)')} AS avg_cpu,
       {r('AVG(memory_usage)')} AS avg_memory, {r('AVG(runtimeCost)')} AS avg_runtime
FROM trace GROUP BY region"""))
def q_region_statistics(spark, sf):
    return round_doubles(prof.region_statistics(trace(spark, sf)))


FUNC_SELECT = (f"funcName, invocations, pods, users, {r('avg_cpu')} AS avg_cpu, {r('avg_memory')} AS avg_memory, "
               f"{r('avg_runtime')} AS avg_runtime")


@register("function_statistics", with_ctes(FUNCS_CTE, select=f"SELECT {FUNC_SELECT} FROM funcs"))
def q_function_statistics(spark, sf):
    return round_doubles(_funcs(spark, sf))


@register("top_functions", with_ctes(FUNCS_CTE, select=
          f"SELECT {FUNC_SELECT} FROM funcs ORDER BY invocations DESC, funcName LIMIT 20"))
def q_top_functions(spark, sf):
    return round_doubles(prof.top_functions(_funcs(spark, sf), 20))


@register("function_reuse", with_ctes(select=f"""
SELECT {r('AVG(n)')} AS avg_requests_per_function, CAST(MIN(n) AS BIGINT) AS min_requests_per_function,
       CAST(MAX(n) AS BIGINT) AS max_requests_per_function
FROM (SELECT funcName, COUNT(*) AS n FROM trace GROUP BY funcName)"""))
def q_function_reuse(spark, sf):
    return round_doubles(prof.function_reuse(trace(spark, sf)))


@register("pod_reuse", with_ctes(select=f"""
SELECT {r('AVG(pods)')} AS avg_pods_per_function
FROM (SELECT funcName, COUNT(DISTINCT podID) AS pods FROM trace GROUP BY funcName)"""))
def q_pod_reuse(spark, sf):
    return round_doubles(prof.pod_reuse(trace(spark, sf)))


@register("cpu_stats", with_ctes(select=
          f"SELECT {r('AVG(cpu_usage)')} AS avg_cpu, {r('MIN(cpu_usage)')} AS min_cpu, {r('MAX(cpu_usage)')} AS max_cpu FROM trace"))
def q_cpu_stats(spark, sf):
    return round_doubles(prof.column_stats(trace(spark, sf), "cpu_usage", "cpu"))


@register("memory_stats", with_ctes(select=
          f"SELECT {r('AVG(memory_usage)')} AS avg_memory, {r('MIN(memory_usage)')} AS min_memory, "
          f"{r('MAX(memory_usage)')} AS max_memory FROM trace"))
def q_memory_stats(spark, sf):
    return round_doubles(prof.column_stats(trace(spark, sf), "memory_usage", "memory"))


CATEGORY_CTE = """q AS (SELECT quantile_cont(invocations, 0.2) AS q20, quantile_cont(invocations, 0.8) AS q80 FROM funcs),
classified AS (
  SELECT f.*, CASE WHEN invocations <= q.q20 THEN 'Rare' WHEN invocations >= q.q80 THEN 'Hot' ELSE 'Normal' END AS category
  FROM funcs f, q
)"""


@register("invocation_category", with_ctes(FUNCS_CTE, CATEGORY_CTE, select=
          "SELECT funcName, invocations, category FROM classified"))
def q_invocation_category(spark, sf):
    return skew.invocation_category(materialize(_funcs(spark, sf))).select("funcName", "invocations", "category")


@register("invocation_category_counts", with_ctes(FUNCS_CTE, CATEGORY_CTE, select=
          "SELECT category, CAST(COUNT(*) AS BIGINT) AS n_functions FROM classified GROUP BY category"))
def q_invocation_category_counts(spark, sf):
    return skew.category_counts(skew.invocation_category(materialize(_funcs(spark, sf))))


@register("category_share", with_ctes(FUNCS_CTE, CATEGORY_CTE, select=
          f"SELECT category, {r('COUNT(*) / (SELECT COUNT(*) FROM classified) * 100.0')} AS pct "
          "FROM classified GROUP BY category"))
def q_category_share(spark, sf):
    return round_doubles(skew.category_share(skew.invocation_category(materialize(_funcs(spark, sf)))))


@register("reuse_ratios", with_ctes(FUNCS_CTE, select=
          f"SELECT funcName, invocations, {r('invocations / pods')} AS requests_per_pod, "
          f"{r('invocations / users')} AS requests_per_user FROM funcs"))
def q_reuse_ratios(spark, sf):
    return round_doubles(skew.reuse_ratios(_funcs(spark, sf)))


@register("reuse_summary", with_ctes(FUNCS_CTE, select=
          f"SELECT {r('AVG(invocations / pods)')} AS mean_requests_per_pod, {r('MAX(invocations / pods)')} AS max_requests_per_pod, "
          f"{r('AVG(invocations / users)')} AS mean_requests_per_user, {r('MAX(invocations / users)')} AS max_requests_per_user "
          "FROM funcs"))
def q_reuse_summary(spark, sf):
    return round_doubles(skew.reuse_summary(skew.reuse_ratios(_funcs(spark, sf))))


@register("lorenz_curve", with_ctes(FUNCS_CTE, select=f"""
SELECT 0.0 AS x, 0.0 AS lorenz
UNION ALL
SELECT {r('ROW_NUMBER() OVER (ORDER BY invocations, funcName) / (SELECT COUNT(*) FROM funcs)')} AS x,
       {r('SUM(invocations) OVER (ORDER BY invocations, funcName ROWS UNBOUNDED PRECEDING) / (SELECT SUM(invocations) FROM funcs)')} AS lorenz
FROM funcs"""))
def q_lorenz_curve(spark, sf):
    return round_doubles(skew.lorenz_curve(_funcs(spark, sf)))


@register("gini", with_ctes(FUNCS_CTE, select=f"""
SELECT {r('2.0 * SUM(i * invocations) / (COUNT(*) * SUM(invocations)) - (COUNT(*) + 1.0) / COUNT(*)')} AS gini
FROM (SELECT invocations, ROW_NUMBER() OVER (ORDER BY invocations, funcName) AS i FROM funcs)"""))
def q_gini(spark, sf):
    return round_doubles(skew.gini(_funcs(spark, sf)))


@register("top_share", with_ctes(FUNCS_CTE, select=f"""
SELECT {", ".join(
    f"{r(f'SUM(CASE WHEN rk <= FLOOR(GREATEST(1.0, n * CAST({p} AS DOUBLE))) THEN invocations ELSE 0 END) / SUM(invocations) * 100.0')} AS top_{k}_pct"
    for p, k in (("0.01", 1), ("0.05", 5), ("0.10", 10)))}
FROM (SELECT invocations, ROW_NUMBER() OVER (ORDER BY invocations DESC, funcName) AS rk, COUNT(*) OVER () AS n FROM funcs)"""))
def q_top_share(spark, sf):
    return round_doubles(skew.top_share(_funcs(spark, sf)))


@register("temporal_hotspots", with_ctes(select=f"""
SELECT CAST(FLOOR(time_worker / 60) AS INTEGER) AS minute, CAST(COUNT(*) AS BIGINT) AS requests,
       CAST(COUNT(DISTINCT funcName) AS BIGINT) AS active_functions, CAST(COUNT(DISTINCT podID) AS BIGINT) AS active_pods,
       {r('AVG(cpu_usage)')} AS avg_cpu, {r('AVG(memory_usage)')} AS avg_memory
FROM trace GROUP BY 1"""))
def q_temporal_hotspots(spark, sf):
    return round_doubles(prof.temporal_hotspots(trace(spark, sf)))


@register("peak_requests_per_minute", with_ctes(select="""
SELECT CAST(MAX(n) AS BIGINT) AS peak_requests_per_minute
FROM (SELECT FLOOR(time_worker / 60) AS m, COUNT(*) AS n FROM trace GROUP BY 1)"""))
def q_peak_requests_per_minute(spark, sf):
    return prof.peak_requests_per_minute(prof.temporal_hotspots(trace(spark, sf)))


@register("function_variation", with_ctes(VARIATION_CTE, select=
          f"SELECT funcName, {r('mean_requests')} AS mean_requests, {r('std_requests')} AS std_requests, {r('cv')} AS cv "
          "FROM variation"))
def q_function_variation(spark, sf):
    return round_doubles(prof.function_variation(trace(spark, sf)))


STAB_CTE = """stab AS (
  SELECT v.*, CASE WHEN cv <= (SELECT MEDIAN(cv) FROM variation) THEN 'Stable' ELSE 'Noisy' END AS stability
  FROM variation v
)"""


@register("stability_by_median", with_ctes(VARIATION_CTE, STAB_CTE, select=
          f"SELECT funcName, {r('cv')} AS cv, stability FROM stab"))
def q_stability_by_median(spark, sf):
    v = skew.stability_by_median(materialize(prof.function_variation(trace(spark, sf))))
    return round_doubles(v.select("funcName", "cv", "stability"))


@register("stability_by_median_hourly", with_ctes(VARIATION_CTE.replace("/ 60)", "/ 3600)"), STAB_CTE, select=
          f"SELECT funcName, {r('cv')} AS cv, stability FROM stab"))
def q_stability_by_median_hourly(spark, sf):
    v = skew.stability_by_median(materialize(prof.function_variation(trace(spark, sf), bucket_seconds=3600)))
    return round_doubles(v.select("funcName", "cv", "stability"))


@register("stability_median_counts", with_ctes(VARIATION_CTE, STAB_CTE, select=
          "SELECT stability, CAST(COUNT(*) AS BIGINT) AS n_functions FROM stab GROUP BY stability"))
def q_stability_median_counts(spark, sf):
    return skew.stability_counts(skew.stability_by_median(materialize(prof.function_variation(trace(spark, sf)))))


@register("rank_size", with_ctes(FUNCS_CTE, select=
          "SELECT CAST(ROW_NUMBER() OVER (ORDER BY invocations DESC, funcName) AS BIGINT) AS rank, funcName, invocations "
          "FROM funcs"))
def q_rank_size(spark, sf):
    return skew.rank_size(materialize(_funcs(spark, sf)))


@register("histogram_requests_per_pod", with_ctes(FUNCS_CTE, _hist_sql(
          "(SELECT invocations / pods AS rpp FROM funcs)", "rpp"), select=HIST_SELECT))
def q_histogram_requests_per_pod(spark, sf):
    return round_doubles(skew.histogram(skew.reuse_ratios(_funcs(spark, sf)), "requests_per_pod", 30))


@register("histogram_cv", with_ctes(VARIATION_CTE, _hist_sql("variation", "cv"), select=HIST_SELECT))
def q_histogram_cv(spark, sf):
    return round_doubles(skew.histogram(prof.function_variation(trace(spark, sf)), "cv", 30))


@register("region_distribution", with_ctes(select=
          "SELECT region, CAST(COUNT(*) AS BIGINT) AS n FROM trace GROUP BY region ORDER BY n DESC, region"))
def q_region_distribution(spark, sf):
    """A3: requests per region, largest first."""
    return (trace(spark, sf).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "region"))


@register("sample_size", with_ctes(select="""
SELECT CAST(LEAST(500, COUNT(*)) AS BIGINT) AS n_rows, CAST(LEAST(500, COUNT(*)) AS BIGINT) AS n_distinct,
       CAST(LEAST(500, COUNT(*)) AS BIGINT) AS n_members FROM events"""))
def q_sample_size(spark, sf):
    """An exact uniform sample of 500 events holds min(500, rows) different rows, all of them of the table."""
    from minutewise.sources.ingest import sample_rows
    events = spark.read.parquet(f"{sf}/events.parquet")
    got = materialize(sample_rows(events, 500))
    members = got.join(events.select(*events.columns), events.columns, "left_semi")
    return got.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_distinct")).crossJoin(
        members.agg(F.count(F.lit(1)).alias("n_members")))


@register("first_rows_count", with_ctes(select="""
SELECT CAST(LEAST(700, COUNT(*)) AS BIGINT) AS n_first, CAST(COUNT(*) AS BIGINT) AS n_all FROM trace"""))
def q_first_rows_count(spark, sf):
    """The first-N source has min(N, rows) rows, N below the row count; without N it has all."""
    from minutewise.sources.ingest import first_rows
    t = trace(spark, sf)
    return first_rows(t, 700).agg(F.count(F.lit(1)).alias("n_first")).crossJoin(
        first_rows(t).agg(F.count(F.lit(1)).alias("n_all")))


@register("sketched_function_statistics", with_ctes(FUNCS_CTE, select=
          "SELECT funcName, invocations, true AS pods_close, true AS users_close FROM funcs"))
def q_sketched_function_statistics(spark, sf):
    """A4 from stored minute sketches: requests are exact, distinct pods and users within 6 standard errors of the exact counts."""
    t = trace(spark, sf)
    kept = stored(sketches.entity_sketches(t), "entity-sketches")
    hourly = sketches.merge_sketches(kept, F.floor(F.col("minute") / 60).alias("hour"), "funcName")  # two steps, as of a store
    rolled = sketches.estimated_entities(hourly, "funcName")
    exact = prof.function_statistics(t).select("funcName", F.col("pods").alias("exact_pods"), F.col("users").alias("exact_users"))
    close = lambda c: F.abs(F.col(c) - F.col(f"exact_{c}")) <= 6 * 1.04 / 2 ** (sketches.LG_K / 2) * F.col(f"exact_{c}")
    both = rolled.join(exact, rolled["funcName"].eqNullSafe(exact["funcName"]))
    return both.select(rolled["funcName"], F.col("requests").alias("invocations"), close("pods").alias("pods_close"),
                       close("users").alias("users_close"))
