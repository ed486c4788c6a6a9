"""Registered queries: ingest (batch and streaming), streaming minute aggregation, the report.

Input files are staged from the driver trace into a fresh folder under the shared checkpoint
directory, so every query still reads the given tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from minutewise.functions.numeric import round_doubles
from minutewise.plans.oracle_sql import r, sparse_cte, with_ctes
from minutewise.plans.registry import register
from minutewise.plans.report import report
from minutewise.schema import KEY, TRACE_SCHEMA
from minutewise.session import scratch_table_path, stored
from minutewise.sources import ingest as ing
from minutewise.sources.fixture import trace
from minutewise.streaming import ingest as sing
from minutewise.streaming import minutes as smin

K = ", ".join(KEY)
ROWS_BY_REGION_SQL = with_ctes(select="SELECT region, CAST(COUNT(*) AS BIGINT) AS n_rows FROM trace GROUP BY region")


def _slots(spark, sf):
    """The trace with the hour of each request: one directory and file for each region and hour."""
    t = trace(spark, sf).withColumn("time_frontend", F.lit(None).cast("double"))
    return t.withColumn("slot", F.floor(F.col("time_worker") / 3600).cast("int"))


def _write_csv(df, base):
    (df.repartition("region", "slot").write.mode("append").option("header", True)
     .partitionBy("region", "slot").csv(base))


def _stage_csv(spark, sf, base):
    """Write the trace as a CSV tree ``region=R/slot=H/part-*.csv`` (declared column order); the number of
    files grows with the time span, and no task or file holds a whole region."""
    _write_csv(_slots(spark, sf).select(*[f.name for f in TRACE_SCHEMA.fields], "region", "slot"), base)


def _stage_mixed_csv(spark, sf, base):
    """As ``_stage_csv``, but R2 has its columns in another order, one the trace does not know and one cost
    column, R5 has text for a number in even hours, and R0 is a file with a header only."""
    t, names = _slots(spark, sf), [f.name for f in TRACE_SCHEMA.fields]
    _write_csv(t.where("region NOT IN ('R2', 'R5')").select(*names, "region", "slot"), base)
    swapped = ["funcName", "clusterName", *[n for n in reversed(names) if n not in ("funcName", "clusterName")]]
    _write_csv(t.where("region = 'R2'").select(*swapped[:4], F.lit("a,b").alias("note"), (F.col("cpu_usage") * 2).alias("workerCost"),
                                               *swapped[4:], "region", "slot"), base)
    text = F.when(F.col("slot") % 2 == 0, F.lit("n/a")).otherwise(F.col("runtimeCost").cast("string"))
    _write_csv(t.where("region = 'R5'").withColumn("runtimeCost", text).select(*names, "region", "slot"), base)
    t.where("1 = 0").select(*names).coalesce(1).write.option("header", True).csv(f"{base}/region=R0/slot=0")


@register("batch_ingest_rows_by_region", ROWS_BY_REGION_SQL)
def q_batch_ingest_rows_by_region(spark, sf):
    base = scratch_table_path(spark, f"ingest-{uuid.uuid4().hex}")
    _stage_csv(spark, sf, f"{base}/csv")
    for _ in range(2):  # the second run finds every file already loaded and adds nothing
        ing.ingest(spark, f"{base}/csv", f"{base}/requests", f"{base}/ledger")
    rows = ing.read_table(spark, f"{base}/requests", f"{base}/ledger")
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"))


@register("stream_ingest_rows_by_region", ROWS_BY_REGION_SQL)
def q_stream_ingest_rows_by_region(spark, sf):
    base = scratch_table_path(spark, f"stream-ingest-{uuid.uuid4().hex}")
    _stage_csv(spark, sf, f"{base}/csv")
    for _ in range(2):  # several micro-batches; the rerun against the same checkpoint adds nothing
        sing.stream_ingest(spark, f"{base}/csv", f"{base}/requests", f"{base}/ledger", f"{base}/checkpoint", 50)
    rows = ing.read_table(spark, f"{base}/requests", f"{base}/ledger")
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"))


@register("import_totals", with_ctes(select="""
SELECT 'SUCCESS' AS status, CAST(COUNT(DISTINCT (region, CAST(FLOOR(time_worker / 3600) AS INTEGER))) AS BIGINT) AS files,
       CAST(COUNT(*) AS BIGINT) AS rows
FROM trace"""))
def q_import_totals(spark, sf):
    """Files and rows by status after ingesting the staged tree (one file per region and hour)."""
    base = scratch_table_path(spark, f"ingest-totals-{uuid.uuid4().hex}")
    _stage_csv(spark, sf, f"{base}/csv")
    ing.ingest(spark, f"{base}/csv", f"{base}/requests", f"{base}/ledger")
    return ing.import_totals(ing.read_ledger(spark, f"{base}/ledger"))


_MIXED_CTE = """mixed AS (
  SELECT *, CAST(FLOOR(time_worker / 3600) AS INTEGER) AS slot,
         region = 'R5' AND CAST(FLOOR(time_worker / 3600) AS INTEGER) % 2 = 0 AS bad FROM trace)"""


def _ingest_mixed(spark, sf):
    base = scratch_table_path(spark, f"ingest-mixed-{uuid.uuid4().hex}")
    _stage_mixed_csv(spark, sf, f"{base}/csv")
    ing.ingest(spark, f"{base}/csv", f"{base}/requests", f"{base}/ledger", files_per_batch=40)
    return base


@register("import_totals_mixed", with_ctes(_MIXED_CTE, """files AS (
  SELECT region, slot, bool_or(bad) AS bad, COUNT(*) AS n FROM mixed GROUP BY region, slot
  UNION ALL SELECT 'R0', 0, false, 0)""", select="""
SELECT CASE WHEN bad THEN 'FAILED' ELSE 'SUCCESS' END AS status, CAST(COUNT(*) AS BIGINT) AS files,
       CAST(SUM(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS rows FROM files GROUP BY 1"""))
def q_import_totals_mixed(spark, sf):
    """S4–S6 over files with other column orders, further columns, a header only, and malformed rows."""
    return ing.import_totals(ing.read_ledger(spark, f"{_ingest_mixed(spark, sf)}/ledger"))


@register("compacted_ledger_totals", with_ctes(_MIXED_CTE, """files AS (
  SELECT region, slot, bool_or(bad) AS bad, COUNT(*) AS n FROM mixed GROUP BY region, slot
  UNION ALL SELECT 'R0', 0, false, 0)""", select="""
SELECT CASE WHEN bad THEN 'FAILED' ELSE 'SUCCESS' END AS status, CAST(COUNT(*) AS BIGINT) AS files,
       CAST(SUM(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS rows,
       CAST(SUM(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS visible_rows FROM files GROUP BY 1"""))
def q_compacted_ledger_totals(spark, sf):
    """The ledger is compacted, the failed files are tried again (and fail again), and it is compacted once more;
    visible_rows are the table's rows from files of the status."""
    base = _ingest_mixed(spark, sf)
    ing.compact_ledger(spark, f"{base}/ledger")
    ing.ingest(spark, f"{base}/csv", f"{base}/requests", f"{base}/ledger", files_per_batch=40)
    ing.compact_ledger(spark, f"{base}/ledger")
    ledger = ing.latest_ledger(ing.read_ledger(spark, f"{base}/ledger"))
    rows = ing.read_table(spark, f"{base}/requests", f"{base}/ledger").groupBy("csv_file").agg(F.count(F.lit(1)).alias("n"))
    return ledger.join(rows, "csv_file", "left").groupBy("status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("rows"), F.sum(F.coalesce("n", F.lit(0))).alias("visible_rows"))


@register("ingest_by_header_name", with_ctes(_MIXED_CTE, select=f"""
SELECT region, clusterName, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(DISTINCT funcName) AS BIGINT) AS n_functions,
       {r('SUM(cpu_usage)')} AS cpu, {r('SUM(memory_usage)')} AS memory, {r('SUM(requestBodySize)')} AS size,
       {r("SUM(CASE WHEN region = 'R2' THEN cpu_usage * 2 END)")} AS worker_cost
FROM mixed WHERE NOT bad GROUP BY region, clusterName"""))
def q_ingest_by_header_name(spark, sf):
    """Values come from the column of their name in every file; absent cost columns are NULL."""
    base = _ingest_mixed(spark, sf)
    rows = ing.read_table(spark, f"{base}/requests", f"{base}/ledger")
    return round_doubles(rows.groupBy("region", "clusterName").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("funcName").alias("n_functions"), F.sum("cpu_usage").alias("cpu"),
        F.sum("memory_usage").alias("memory"), F.sum("requestBodySize").alias("size"), F.sum("workerCost").alias("worker_cost")))


MINUTES_SQL = (f"SELECT minute, {K}, requests, " + ", ".join(
    f"{r(c)} AS {c}" for c in ["avg_cpu", "avg_memory", "avg_runtime", "avg_request_size"]) + ", active_pods, active_users FROM sparse")


def _replay(spark, name, t, parts, last):
    """Run the watermarked stream over parts of a trace in the order of their arrival, each written as its own files
    and taken by a run of its own; then end the stream. Returns the closed minutes and the rows dropped as late."""
    base = scratch_table_path(spark, f"{name}-{uuid.uuid4().hex}")
    dropped = 0
    for i, part in enumerate([*parts, smin.end_of_stream(spark, t.schema, last)]):
        part.write.parquet(f"{base}/source/part-{i}")
        info = smin.run_watermarked_minutes(spark, f"{base}/source/*", f"{base}/out", f"{base}/checkpoint", t.schema)
        dropped += info["rows_dropped_by_watermark"]
    return smin.closed_minutes(spark, f"{base}/out"), dropped


def _time_bounds(t):
    b = t.agg(F.min("time_worker").alias("lo"), F.max("time_worker").alias("hi")).first()
    return b["lo"] or 0.0, b["hi"] or 0.0


@register("stream_minute_aggregate", with_ctes(sparse_cte(), select=MINUTES_SQL))
def q_stream_minute_aggregate(spark, sf):
    """The trace replayed as a stream in two parts under a watermark equals the batch minute aggregate in every
    column, distinct pods and users included."""
    t = trace(spark, sf)
    lo, hi = _time_bounds(t)
    first = F.col("time_worker") < (lo + hi) / 2
    out, dropped = _replay(spark, "stream-minutes", t, [t.where(first), t.where(~first)], hi)
    if dropped:
        raise RuntimeError(f"{dropped} rows of a trace in order were dropped as late")
    return round_doubles(out)


REPORT_SQL = with_ctes("""funcs AS (
  SELECT funcName, COUNT(*) AS invocations, COUNT(DISTINCT podID) AS pods, COUNT(DISTINCT userID) AS users
  FROM trace GROUP BY funcName),
q AS (SELECT quantile_cont(invocations, 0.2) AS q20, quantile_cont(invocations, 0.8) AS q80 FROM funcs),
cls AS (SELECT CASE WHEN invocations <= q20 THEN 'Rare' WHEN invocations >= q80 THEN 'Hot' ELSE 'Normal' END AS category
        FROM funcs, q),
ranked AS (SELECT invocations, ROW_NUMBER() OVER (ORDER BY invocations, funcName) AS i,
                  ROW_NUMBER() OVER (ORDER BY invocations DESC, funcName) AS rk, COUNT(*) OVER () AS n FROM funcs),
pm AS (SELECT funcName, FLOOR(time_worker / 60) AS m, COUNT(*) AS c FROM trace GROUP BY 1, 2),
var AS (SELECT funcName, STDDEV(c) / AVG(c) AS cv FROM pm GROUP BY funcName),
stab AS (SELECT CASE WHEN cv <= (SELECT MEDIAN(cv) FROM var) THEN 'Stable' ELSE 'Noisy' END AS stability FROM var),
lines AS (
  SELECT 'DATASET SUMMARY' AS section, metric, value FROM (
    SELECT COUNT(*) AS "Requests", COUNT(DISTINCT funcName) AS "Functions", COUNT(DISTINCT userID) AS "Users",
           COUNT(DISTINCT podID) AS "Pods", COUNT(DISTINCT clusterName) AS "Clusters",
           COUNT(DISTINCT region) AS "Regions", AVG(cpu_usage) AS "Average CPU", AVG(memory_usage) AS "Average Memory",
           AVG(runtimeCost) AS "Average Runtime", MIN(time_worker) AS "Start Time", MAX(time_worker) AS "End Time"
    FROM trace) UNPIVOT (value FOR metric IN (COLUMNS(*)))
  UNION ALL SELECT 'REGION REQUESTS', region, COUNT(*) FROM trace GROUP BY region
  UNION ALL SELECT 'FUNCTION CLASSIFICATION', category, COUNT(*) FROM cls GROUP BY category
  UNION ALL SELECT 'FUNCTION REUSE', metric, value FROM (
    SELECT AVG(invocations / pods) AS mean_requests_per_pod, MAX(invocations / pods) AS max_requests_per_pod,
           AVG(invocations / users) AS mean_requests_per_user, MAX(invocations / users) AS max_requests_per_user
    FROM funcs) UNPIVOT (value FOR metric IN (COLUMNS(*)))
  UNION ALL SELECT 'WORKLOAD SKEW', metric, value FROM (
    SELECT 2.0 * SUM(i * invocations) / (COUNT(*) * SUM(invocations)) - (COUNT(*) + 1.0) / COUNT(*) AS gini,
           SUM(CASE WHEN rk <= FLOOR(GREATEST(1.0, n * CAST(0.01 AS DOUBLE))) THEN invocations ELSE 0 END) / SUM(invocations) * 100.0 AS top_1_pct,
           SUM(CASE WHEN rk <= FLOOR(GREATEST(1.0, n * CAST(0.05 AS DOUBLE))) THEN invocations ELSE 0 END) / SUM(invocations) * 100.0 AS top_5_pct,
           SUM(CASE WHEN rk <= FLOOR(GREATEST(1.0, n * CAST(0.1 AS DOUBLE))) THEN invocations ELSE 0 END) / SUM(invocations) * 100.0 AS top_10_pct
    FROM ranked) UNPIVOT (value FOR metric IN (COLUMNS(*)))
  UNION ALL SELECT 'TEMPORAL HOTSPOTS', 'peak_requests_per_minute', MAX(c) FROM (
    SELECT FLOOR(time_worker / 60) AS m, COUNT(*) AS c FROM trace GROUP BY 1)
  UNION ALL SELECT 'STABLE VS NOISY', stability, COUNT(*) FROM stab GROUP BY stability
)""", select=f"SELECT section, metric, {r('value')} AS value FROM lines")


@register("report", REPORT_SQL)
def q_report(spark, sf):
    return round_doubles(report(trace(spark, sf)))


@register("stream_minute_aggregate_exact", with_ctes(sparse_cte(), select=
          f"SELECT minute, {K}, requests, " + ", ".join(
              f"{r(c)} AS {c}" for c in ["avg_cpu", "avg_memory", "avg_runtime", "avg_request_size"])
          + ", active_pods, active_users FROM sparse"))
def q_stream_minute_aggregate_exact(spark, sf):
    """X2 (exact): the trace replayed as a stream in several micro-batches, merged exactly —
    equal to the batch minute aggregate in every column, distinct pods/users included."""
    base = scratch_table_path(spark, f"stream-exact-{uuid.uuid4().hex}")
    t = trace(spark, sf)
    half = F.xxhash64("userID") % 2 == 0
    for i, part in enumerate((t.where(half), t.where(~half))):  # each in as many files as its scan has tasks
        part.write.parquet(f"{base}/source/part-{i}")
        smin.run_exact_minute_stream(spark, f"{base}/source/*", f"{base}/out", f"{base}/checkpoint", t.schema)
    return round_doubles(smin.exact_minutes(spark, f"{base}/out"))


@register("stream_minute_update_mode", with_ctes(sparse_cte(), select=
          f"SELECT minute, {K}, requests, " + ", ".join(
              f"{r(c)} AS {c}" for c in ["avg_cpu", "avg_memory", "avg_runtime", "avg_request_size"])
          + " FROM sparse"))
def q_stream_minute_update_mode(spark, sf):
    """X2 in update mode, open minutes included: equals the batch minute aggregate (requests, means)."""
    base = scratch_table_path(spark, f"stream-update-{uuid.uuid4().hex}")
    t = trace(spark, sf)
    t.write.mode("overwrite").parquet(f"{base}/source")
    smin.run_minute_stream(spark, f"{base}/source", f"{base}/out", f"{base}/checkpoint", t.schema)
    res = smin.latest_minutes(spark.read.parquet(f"{base}/out"))
    return round_doubles(res.select("minute", *KEY, "requests", "avg_cpu", "avg_memory", "avg_runtime",
                                    "avg_request_size"))


@register("stream_minute_late_rows", with_ctes("""kept AS (
  SELECT * FROM trace WHERE time_worker >= (SELECT (MIN(time_worker) + MAX(time_worker)) / 2 - 3600 FROM trace)
                            OR CAST(userID AS BIGINT) % 10 <> 0)""", select=f"""
SELECT CAST(FLOOR(time_worker / 60) AS INTEGER) AS minute, {K}, CAST(COUNT(*) AS BIGINT) AS requests,
       {r('AVG(cpu_usage)')} AS avg_cpu, CAST(COUNT(DISTINCT podID) AS BIGINT) AS active_pods,
       CAST(COUNT(DISTINCT userID) AS BIGINT) AS active_users FROM kept GROUP BY ALL"""))
def q_stream_minute_late_rows(spark, sf):
    """Three parts; the last brings rows of the first half of the day after the watermark has passed the second
    half, and all of them are dropped."""
    t = trace(spark, sf)
    lo, hi = _time_bounds(t)
    early = F.col("time_worker") < (lo + hi) / 2
    # late rows lie an hour before the end of the first part: what is late follows from the batch before the last
    late = (F.col("time_worker") < (lo + hi) / 2 - 3600) & (F.col("userID").cast("long") % 10 == 0)
    out, dropped = _replay(spark, "stream-late", t, [t.where(early & ~late), t.where(~early), t.where(late)], hi)
    if not dropped:
        raise RuntimeError("no late row was counted")
    return round_doubles(out.select("minute", *KEY, "requests", "avg_cpu", "active_pods", "active_users"))


@register("catalog_round_trip", with_ctes(select="""
SELECT CAST(COUNT(*) AS BIGINT) AS n_view, CAST(COUNT(*) AS BIGINT) AS n_statistics, CAST(10 AS BIGINT) AS n_columns,
       true AS listed FROM trace"""))
def q_catalog_round_trip(spark, sf):
    """A view over the trace, the catalog's look at it, and the row count that ANALYZE stores."""
    from minutewise.sources import catalog
    name = f"trace_{uuid.uuid4().hex}"
    catalog.register_view(trace(spark, sf), f"{name}_view")
    catalog.save_table(spark.table(f"{name}_view"), name, path=scratch_table_path(spark, name))
    stats = catalog.analyze(spark, name).where("col_name = 'Statistics'").first()["data_type"]
    n = int(stats.split(",")[-1].split()[0])
    listed = catalog.table_exists(spark, name) and f"{name}_view" in catalog.list_tables(spark)
    out = spark.table(f"{name}_view").agg(F.count(F.lit(1)).alias("n_view"), F.lit(n).cast("long").alias("n_statistics"),
                                          F.lit(len(catalog.describe(spark, name))).cast("long").alias("n_columns"),
                                          F.lit(listed).alias("listed"))
    spark.sql(f"DROP TABLE {name}")
    return out


@register("csv_sink_round_trip", with_ctes(sparse_cte(), select=f"""
SELECT {K}, CAST(SUM(requests) AS BIGINT) AS requests, CAST(COUNT(*) AS BIGINT) AS minutes FROM sparse GROUP BY ALL"""))
def q_csv_sink_round_trip(spark, sf):
    """The minute table written as CSV with a header and read back by its names."""
    from minutewise.operators.minutes import minute_aggregate
    from minutewise.sources import catalog
    path = scratch_table_path(spark, f"csv-{uuid.uuid4().hex}")
    catalog.write_csv(minute_aggregate(trace(spark, sf)), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy(*KEY).agg(F.sum(F.col("requests").cast("long")).alias("requests"), F.count(F.lit(1)).alias("minutes"))


@register("ensured_columns", with_ctes(select=f"""
SELECT {r('SUM(0.0)')} AS bus_cost, {r('SUM(cpu_usage)')} AS cpu, {r('SUM(0.5)')} AS fallback,
       {r('SUM(COALESCE(TRY_CAST(substr(podID, 4) AS DOUBLE), 0.0))')} AS pod_number FROM trace"""))
def q_ensured_columns(spark, sf):
    """Missing columns get a default, and the first candidate that is present is read as a number."""
    from minutewise.operators.rawtrace import ensure_columns, select_numeric
    t = ensure_columns(trace(spark, sf).withColumn("pod_text", F.substr("podID", F.lit(4))), ["busCost", "cpu_usage"])
    return round_doubles(t.agg(F.sum("busCost").alias("bus_cost"), F.sum("cpu_usage").alias("cpu"),
                               F.sum(select_numeric(t, ["absent"], 0.5)).alias("fallback"),
                               F.sum(select_numeric(t, ["absent", "pod_text"])).alias("pod_number")))


_MANY_CTE = """many AS (SELECT * EXCLUDE (funcName), 'u' || userID || '-' || podID AS funcName FROM trace),
mtot AS (SELECT region, clusterName, funcName, CAST(COUNT(*) AS BIGINT) AS total_requests FROM many GROUP BY ALL),
mq AS (SELECT quantile_cont(total_requests, 0.8) AS qh, quantile_cont(total_requests, 0.25) AS qr FROM mtot)"""


@register("many_groups_category", with_ctes(_MANY_CTE, select=f"""
SELECT {K}, total_requests, CASE WHEN total_requests >= qh THEN 'Hot' WHEN total_requests <= qr THEN 'Rare' ELSE 'Normal' END AS category
FROM mtot, mq"""))
def q_many_groups_category(spark, sf):
    """F6/F7 with one function for each user and pod: groups grow with the trace, unlike the fixture's 250."""
    from minutewise.operators import metadata as meta
    from minutewise.operators.minutes import minute_aggregate
    t = trace(spark, sf).withColumn("funcName", F.concat(F.lit("u"), "userID", F.lit("-"), "podID"))
    totals = stored(meta.group_totals(minute_aggregate(t)), "many-totals")
    return totals.select("*", meta.volume_category(totals).alias("category"))
