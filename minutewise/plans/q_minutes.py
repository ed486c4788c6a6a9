"""Registered queries: minute aggregation, calendar, verification, metadata, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from minutewise.functions.numeric import round_doubles
from minutewise.operators import features as feat
from minutewise.operators import metadata as meta
from minutewise.operators import minutes as mins
from minutewise.operators import quality as qual
from minutewise.plans.oracle_sql import dense_cte, features_cte, meta_cte, r, sparse_cte, with_ctes
from minutewise.plans.registry import register
from minutewise.session import materialize
from minutewise.sources.fixture import trace


def _sparse(spark, sf, bucket=60):
    return mins.minute_aggregate(trace(spark, sf), bucket_seconds=bucket)


def sparse_checkpointed(spark, sf, bucket=60):
    """The sparse minute table cut at a reliable checkpoint: raw requests are read once."""
    return materialize(_sparse(spark, sf, bucket))


def dense_checkpointed(spark, sf, bucket=60):
    """Dense calendar over the checkpointed sparse table (lazy, partitioned by group)."""
    return mins.dense_calendar(sparse_checkpointed(spark, sf, bucket))


MINUTE_COLS_SQL = ("minute, region, clusterName, funcName, requests, " + ", ".join(
    f"{r(c)} AS {c}" for c in ["avg_cpu", "avg_memory", "avg_runtime", "avg_request_size"])
    + ", active_pods, active_users")


@register("minute_aggregate", with_ctes(sparse_cte(), select=f"SELECT {MINUTE_COLS_SQL} FROM sparse"))
def q_minute_aggregate(spark, sf):
    return round_doubles(_sparse(spark, sf))


@register("minute_bounds", with_ctes(sparse_cte(), select=
          "SELECT MIN(minute) AS first_minute, MAX(minute) AS last_minute FROM sparse"))
def q_minute_bounds(spark, sf):
    return mins.minute_bounds(_sparse(spark, sf))


@register("function_groups", with_ctes(sparse_cte(), select=
          "SELECT DISTINCT region, clusterName, funcName FROM sparse"))
def q_function_groups(spark, sf):
    return mins.function_groups(_sparse(spark, sf))


@register("minute_calendar", with_ctes(sparse_cte(), select=
          "SELECT CAST(range AS INTEGER) AS minute FROM range((SELECT MIN(minute) FROM sparse), "
          "(SELECT MAX(minute) FROM sparse) + 1)"))
def q_minute_calendar(spark, sf):
    return mins.minute_calendar(_sparse(spark, sf))


@register("dense_calendar", with_ctes(sparse_cte(), dense_cte(), select=f"SELECT {MINUTE_COLS_SQL} FROM dense"))
def q_dense_calendar(spark, sf):
    return round_doubles(dense_checkpointed(spark, sf))


@register("dense_calendar_hourly", with_ctes(sparse_cte(3600), dense_cte(), select=
          f"SELECT {MINUTE_COLS_SQL} FROM dense"))
def q_dense_calendar_hourly(spark, sf):
    return round_doubles(dense_checkpointed(spark, sf, 3600))


@register("dense_zero_rows", with_ctes(sparse_cte(), dense_cte(), select=
          "SELECT CAST(COUNT(*) AS BIGINT) AS dense_rows, "
          "CAST(COUNT(*) FILTER (WHERE requests = 0) AS BIGINT) AS zero_rows FROM dense"))
def q_dense_zero_rows(spark, sf):
    return qual.zero_rows(dense_checkpointed(spark, sf))


@register("calendar_completeness", with_ctes(sparse_cte(), dense_cte(), select="""
SELECT CAST((SELECT COUNT(*) FROM (SELECT DISTINCT region, clusterName, funcName FROM dense))
            * ((SELECT MAX(minute) FROM dense) - (SELECT MIN(minute) FROM dense) + 1) AS BIGINT) AS expected_rows,
       CAST((SELECT COUNT(*) FROM (
          SELECT region, clusterName, funcName, COUNT(*) AS n, MIN(minute) AS a, MAX(minute) AS b
          FROM dense GROUP BY ALL) g
        WHERE g.n <> (SELECT MAX(minute) - MIN(minute) + 1 FROM dense)
           OR g.a <> (SELECT MIN(minute) FROM dense) OR g.b <> (SELECT MAX(minute) FROM dense)) AS BIGINT)
       AS invalid_groups"""))
def q_calendar_completeness(spark, sf):
    return qual.calendar_completeness(dense_checkpointed(spark, sf))


@register("dense_summary", with_ctes(sparse_cte(), dense_cte(), select=
          "SELECT MIN(minute) AS min_minute, MAX(minute) AS max_minute, "
          "CAST(COUNT(DISTINCT funcName) AS BIGINT) AS n_functions, "
          "CAST(COUNT(DISTINCT region) AS BIGINT) AS n_regions FROM dense"))
def q_dense_summary(spark, sf):
    return qual.dense_summary(dense_checkpointed(spark, sf))


@register("request_conservation", with_ctes(sparse_cte(), dense_cte(), select=
          "SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM trace) AS raw_requests, "
          "(SELECT CAST(SUM(requests) AS BIGINT) FROM sparse) AS sparse_requests, "
          "(SELECT CAST(SUM(requests) AS BIGINT) FROM dense) AS dense_requests"))
def q_request_conservation(spark, sf):
    t = trace(spark, sf)
    sp = materialize(mins.minute_aggregate(t))
    return qual.conservation(t, sp, mins.dense_calendar(sp))


@register("trace_row_count", with_ctes(select="SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM trace"))
def q_trace_row_count(spark, sf):
    return qual.row_count(trace(spark, sf))


@register("rows_by_region", with_ctes(select=
          "SELECT region, CAST(COUNT(*) AS BIGINT) AS n_rows FROM trace GROUP BY region"))
def q_rows_by_region(spark, sf):
    return qual.rows_by_region(trace(spark, sf))


@register("distinct_entities", with_ctes(select=
          "SELECT CAST(COUNT(DISTINCT funcName) AS BIGINT) AS n_functions, "
          "CAST(COUNT(DISTINCT userID) AS BIGINT) AS n_users, CAST(COUNT(DISTINCT podID) AS BIGINT) AS n_pods, "
          "CAST(COUNT(DISTINCT clusterName) AS BIGINT) AS n_clusters FROM trace"))
def q_distinct_entities(spark, sf):
    return qual.distinct_entities(trace(spark, sf))


@register("time_range", with_ctes(select=
          f"SELECT {r('MIN(time_worker)')} AS min_time, {r('MAX(time_worker)')} AS max_time FROM trace"))
def q_time_range(spark, sf):
    return round_doubles(qual.time_range(trace(spark, sf)))


@register("dense_preview", with_ctes(sparse_cte(), dense_cte(), select=
          f"SELECT {MINUTE_COLS_SQL} FROM dense ORDER BY minute, region, clusterName, funcName LIMIT 10"))
def q_dense_preview(spark, sf):
    return round_doubles(qual.preview(dense_checkpointed(spark, sf), 10))


META_COLS_SQL = ("region, clusterName, funcName, total_requests, " + ", ".join(
    f"{r(c)} AS {c}" for c in ["avg_cpu", "avg_memory", "avg_runtime", "std_requests", "mean_requests"]))


@register("group_statistics", with_ctes(sparse_cte(), dense_cte(), meta_cte(), select=
          f"SELECT {META_COLS_SQL} FROM meta_stats"))
def q_group_statistics(spark, sf):
    return round_doubles(meta.group_statistics(dense_checkpointed(spark, sf)))


@register("function_metadata", with_ctes(sparse_cte(), dense_cte(), meta_cte(), select=
          f"SELECT {META_COLS_SQL}, category, stability FROM meta"))
def q_function_metadata(spark, sf):
    return round_doubles(meta.function_metadata(dense_checkpointed(spark, sf)))


@register("function_metadata_hourly", with_ctes(sparse_cte(3600), dense_cte(), meta_cte(), select=
          f"SELECT {META_COLS_SQL}, category, stability FROM meta"))
def q_function_metadata_hourly(spark, sf):
    return round_doubles(meta.function_metadata(dense_checkpointed(spark, sf, 3600)))


@register("category_counts", with_ctes(sparse_cte(), dense_cte(), meta_cte(), select=
          "SELECT category, CAST(COUNT(*) AS BIGINT) AS n_groups FROM meta GROUP BY category"))
def q_category_counts(spark, sf):
    return meta.category_counts(meta.function_metadata(dense_checkpointed(spark, sf)))


@register("stability_counts_hourly", with_ctes(sparse_cte(3600), dense_cte(), meta_cte(), select=
          "SELECT stability, CAST(COUNT(*) AS BIGINT) AS n_groups FROM meta GROUP BY stability"))
def q_stability_counts_hourly(spark, sf):
    return meta.stability_counts(meta.function_metadata(dense_checkpointed(spark, sf, 3600)))


FEATURE_NUM = ["rolling_mean_5", "rolling_mean_15", "rolling_mean_30", "rolling_std", "rolling_median",
               "warm_capacity", "avg_cpu", "avg_memory", "avg_runtime", "avg_request_size", "growth_rate",
               "coeff_variation", "cpu_per_request", "memory_per_request", "runtime_per_request", "warm_ratio",
               "hour_sin", "hour_cos", "minute_sin", "minute_cos"]
FEATURE_PLAIN = ["region", "clusterName", "funcName", "minute", "requests", "active_pods", "active_users",
                 "lag_1", "lag_5", "lag_15", "lag_30", "rolling_max", "rolling_min", "category", "stability",
                 "total_requests", "trend", "minute_of_hour", "hour_of_day"]
FEATURE_SELECT_SQL = ", ".join(FEATURE_PLAIN + [f"{r(c)} AS {c}" for c in FEATURE_NUM])


@register("feature_table", with_ctes(sparse_cte(), dense_cte(), meta_cte(), features_cte(), select=
          f"SELECT {FEATURE_SELECT_SQL} FROM feat"))
def q_feature_table(spark, sf):
    sparse = sparse_checkpointed(spark, sf)
    features = feat.feature_table(mins.dense_calendar(sparse), group_totals=meta.group_totals(sparse))
    return round_doubles(features)


@register("feature_table_joined_metadata", with_ctes(sparse_cte(), dense_cte(), meta_cte(), features_cte(), select=
          f"SELECT {FEATURE_SELECT_SQL} FROM feat"))
def q_feature_table_joined_metadata(spark, sf):
    d = dense_checkpointed(spark, sf)
    return round_doubles(feat.feature_table(d, meta.function_metadata(d)))


@register("raw_variant_features", with_ctes(sparse_cte(), dense_cte(), features_cte(
          meta=None, std="STDDEV_POP", zero_div="zero"), select=
          f"SELECT {FEATURE_SELECT_SQL} FROM feat"))
def q_raw_variant_features(spark, sf):
    f = feat.raw_variant_features(dense_checkpointed(spark, sf))
    f = f.select("*", F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("stability"),
                 F.lit(None).cast("long").alias("total_requests"))
    return round_doubles(f.select(*FEATURE_PLAIN, *FEATURE_NUM))


SPARSE_ROLL_NUM = ["rolling_mean_5", "rolling_mean_15", "rolling_mean_30", "rolling_std_15", "rolling_std_30",
                   "ema_10", "warm_capacity", "growth_rate"]


@register("sparse_rolling_features", with_ctes(sparse_cte(), select=f"""
SELECT minute, region, clusterName, funcName, requests, prev_requests, trend,
       {", ".join(f"{r(c)} AS {c}" for c in SPARSE_ROLL_NUM)}
FROM (
  SELECT *, requests - COALESCE(prev_requests, requests) AS trend,
         CASE WHEN COALESCE(prev_requests, 0) = 0 THEN 0.0
              ELSE (requests - prev_requests) / prev_requests END AS growth_rate
  FROM (
    SELECT *,
      LAG(requests) OVER w AS prev_requests,
      AVG(requests) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rolling_mean_5,
      AVG(requests) OVER (w ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS rolling_mean_15,
      AVG(requests) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_mean_30,
      STDDEV_SAMP(requests) OVER (w ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS rolling_std_15,
      STDDEV_SAMP(requests) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_std_30,
      AVG(requests) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ema_10,
      QUANTILE_CONT(requests, 0.9) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS warm_capacity
    FROM sparse
    WINDOW w AS (PARTITION BY region, clusterName, funcName ORDER BY minute)
  )
)"""))
def q_sparse_rolling_features(spark, sf):
    f = feat.sparse_rolling_features(_sparse(spark, sf))
    return round_doubles(f.select("minute", "region", "clusterName", "funcName", "requests", "prev_requests",
                                  "trend", *SPARSE_ROLL_NUM))


@register("short_groups_dropped", with_ctes(sparse_cte(), select="""
SELECT region, clusterName, funcName, CAST(COUNT(*) AS BIGINT) AS n_rows FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY region, clusterName, funcName) AS n FROM sparse) WHERE n >= 70
GROUP BY ALL"""))
def q_short_groups_dropped(spark, sf):
    kept = feat.drop_short_groups(_sparse(spark, sf), 70)
    return kept.groupBy("region", "clusterName", "funcName").agg(F.count(F.lit(1)).alias("n_rows"))


@register("feature_build_tables", with_ctes(sparse_cte(), dense_cte(), meta_cte(), features_cte(), select="""
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM sparse) AS sparse_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM dense) AS dense_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM meta) AS metadata_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM feat) AS feature_rows,
       (SELECT CAST(SUM(requests) AS BIGINT) FROM feat) AS feature_requests,
       (SELECT CAST(COUNT(*) FILTER (WHERE requests = 0) AS BIGINT) FROM dense) AS zero_rows"""))
def q_feature_build_tables(spark, sf):
    """E2 end to end: writes the four tables, gates the calendar, then reads the tables back."""
    import uuid
    from minutewise.plans.feature_build import build_feature_tables
    from minutewise.session import scratch_table_path
    res = build_feature_tables(trace(spark, sf), scratch_table_path(spark, f"features-{uuid.uuid4().hex}"))
    p = res["paths"]
    rd = spark.read.parquet
    dense = rd(p["dense"])
    feats = rd(p["features"])
    return rd(p["sparse"]).agg(F.count(F.lit(1)).alias("sparse_rows")).select(
        "sparse_rows",
        dense.select(F.count(F.lit(1))).scalar().alias("dense_rows"),
        rd(p["metadata"]).select(F.count(F.lit(1))).scalar().alias("metadata_rows"),
        feats.select(F.count(F.lit(1))).scalar().alias("feature_rows"),
        feats.select(F.sum("requests")).scalar().alias("feature_requests"),
        dense.select(F.count_if(F.col("requests") == 0)).scalar().alias("zero_rows"))
