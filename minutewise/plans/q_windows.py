"""Registered queries: forecast dataset (D1–D18, V10) over the full feature table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from minutewise.functions.numeric import round_doubles
from minutewise.operators import features as feat
from minutewise.operators import metadata as meta
from minutewise.operators import minutes as mins
from minutewise.operators import quality as qual
from minutewise.operators import splits
from minutewise.operators import windows as win
from minutewise.plans.oracle_sql import dense_cte, features_cte, meta_cte, r, sparse_cte, with_ctes
from minutewise.plans.q_minutes import sparse_checkpointed
from minutewise.plans.registry import register
from minutewise.schema import HISTORY, HORIZON, KEY, PAST_VALUE_FEATURES, TIME_FEATURES, V1_FEATURES
from minutewise.session import scratch_table_path, stored
from minutewise.sources import catalog

K = ", ".join(KEY)
FEAT_CTES = [sparse_cte(), dense_cte(), meta_cte(), features_cte()]


def _features(spark, sf):
    """The feature table, written once and read by every pass of a query (partitioned by region)."""
    sparse = sparse_checkpointed(spark, sf)
    table = feat.feature_table(mins.dense_calendar(sparse), group_totals=meta.group_totals(sparse))
    return stored(table, "features", "region")


GROUPS_CTE = f"""wgroups AS (
  SELECT {K}, CAST(COUNT(*) AS BIGINT) AS row_count, MAX(category) AS category, MAX(stability) AS stability
  FROM feat GROUP BY ALL HAVING COUNT(*) >= 70
)"""
INDEX_CTE = f"""widx AS (
  SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {K}) - 1 AS BIGINT) AS group_id,
         CAST(SUM(n_windows) OVER (ORDER BY {K} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS off0
  FROM (SELECT *, row_count - 70 + 1 AS n_windows FROM wgroups)
)"""
WINDOWS_CTE = f"""wrows AS (
  SELECT {K}, minute, CAST(ROW_NUMBER() OVER w - 1 AS INTEGER) AS pos,
         MAX(requests) OVER (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) > 0 AS active
  FROM feat WINDOW w AS (PARTITION BY {K} ORDER BY minute)
),
wins AS (
  SELECT w.region, w.clusterName, w.funcName, i.group_id, w.minute AS origin_minute, w.pos - 59 AS start,
         CAST(i.n_windows AS BIGINT) AS n_windows, CAST(COALESCE(i.off0, 0) + w.pos - 59 AS BIGINT) AS window_index,
         w.active
  FROM wrows w JOIN widx i USING ({K})
  WHERE w.pos >= 59 AND w.pos <= i.row_count - 11
)"""


def _windows(spark, sf):
    """The window table needs the calendar alone, and the lengths of its series follow from the sparse minutes."""
    sparse = sparse_checkpointed(spark, sf)
    return win.windows(mins.dense_calendar(sparse), groups=win.calendar_groups(sparse))


def _stored_windows(spark, sf):
    return stored(_windows(spark, sf), "windows")


@register("window_groups", with_ctes(*FEAT_CTES, GROUPS_CTE, select="SELECT * FROM wgroups"))
def q_window_groups(spark, sf):
    return win.group_windows_meta(_features(spark, sf))


@register("group_subset", with_ctes(*FEAT_CTES, GROUPS_CTE, select=f"""
SELECT g.* FROM wgroups g SEMI JOIN (
  SELECT {K} FROM wgroups ORDER BY md5(concat_ws('::', {K})), {K} LIMIT 50) s USING ({K})"""))
def q_group_subset(spark, sf):
    return win.group_subset(win.group_windows_meta(_features(spark, sf)), 50)


@register("vocabulary_function", with_ctes(*FEAT_CTES, GROUPS_CTE, select="""
SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS BIGINT) AS id
FROM (SELECT DISTINCT concat_ws('::', region, clusterName, funcName) AS value FROM wgroups)"""))
def q_vocabulary_function(spark, sf):
    return win.vocabulary(win.group_windows_meta(_features(spark, sf)), win.function_key())


@register("vocabulary_region", with_ctes(*FEAT_CTES, GROUPS_CTE, select="""
SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS BIGINT) AS id
FROM (SELECT DISTINCT region AS value FROM wgroups)"""))
def q_vocabulary_region(spark, sf):
    return win.vocabulary(win.group_windows_meta(_features(spark, sf)), "region")


@register("vocabulary_cluster", with_ctes(*FEAT_CTES, GROUPS_CTE, select="""
SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS BIGINT) AS id
FROM (SELECT DISTINCT clusterName AS value FROM wgroups)"""))
def q_vocabulary_cluster(spark, sf):
    return win.vocabulary(win.group_windows_meta(_features(spark, sf)), "clusterName")


@register("static_codes", with_ctes(*FEAT_CTES, GROUPS_CTE, select="""
SELECT region, clusterName, funcName,
  CASE WHEN category IS NULL THEN 0 WHEN category = 'Rare' THEN 0 WHEN category = 'Normal' THEN 1
       WHEN category = 'Hot' THEN 2 ELSE 0 END AS category_id,
  CASE WHEN stability IS NULL THEN 0 WHEN stability = 'Stable' THEN 0 WHEN stability = 'Noisy' THEN 1
       ELSE 1 END AS stability_id,
  CASE WHEN stability IS NULL THEN 0 WHEN stability = 'Stable' THEN 0 WHEN stability = 'Noisy' THEN 1
       ELSE 0 END AS stability_id_v1
FROM wgroups"""))
def q_static_codes(spark, sf):
    g = win.group_windows_meta(_features(spark, sf))
    codes = win.encoded_classes(g)
    return g.select(*KEY, codes["category_id"].alias("category_id"), codes["stability_id"].alias("stability_id"),
                    win.encode_stability(mode="v1").alias("stability_id_v1"))


STATS_SQL = ", ".join(
    f"{r(f'AVG(COALESCE({c}, 0.0))')} AS {c}_mean" for c in PAST_VALUE_FEATURES) + ", " + ", ".join(
    f"{r(f'CASE WHEN COALESCE(STDDEV_POP(COALESCE({c}, 0.0)), 0.0) = 0 THEN 1.0 ELSE STDDEV_POP(COALESCE({c}, 0.0)) END')} AS {c}_std"
    for c in PAST_VALUE_FEATURES)


@register("feature_statistics", with_ctes(*FEAT_CTES, select=f"SELECT {STATS_SQL} FROM feat"))
def q_feature_statistics(spark, sf):
    return round_doubles(win.feature_statistics(_features(spark, sf)))


@register("window_index", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, select=
          f"SELECT {K}, row_count, category, stability, CAST(n_windows AS BIGINT) AS n_windows, group_id, "
          "COALESCE(off0, 0) AS offset FROM widx"))
def q_window_index(spark, sf):
    return win.window_index(win.group_windows_meta(_features(spark, sf)))


@register("window_table", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, select="SELECT * FROM wins"))
def q_window_table(spark, sf):
    return _windows(spark, sf)


SPLIT_CTE = """wsplit AS (
  SELECT *, CASE WHEN start < train_end THEN 'train' WHEN start < val_end THEN 'validation' ELSE 'test' END AS split
  FROM (
    SELECT *, GREATEST(train_end0 + 1, LEAST(n_windows - 1, CAST(FLOOR(n_windows * 0.9) AS BIGINT))) AS val_end
    FROM (SELECT *, GREATEST(1, LEAST(n_windows - 2, CAST(FLOOR(n_windows * 0.8) AS BIGINT))) AS train_end0,
                 GREATEST(1, LEAST(n_windows - 2, CAST(FLOOR(n_windows * 0.8) AS BIGINT))) AS train_end
          FROM wins)
  )
)"""


@register("window_splits", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, SPLIT_CTE, select=
          f"SELECT {K}, window_index, start, split FROM wsplit"))
def q_window_splits(spark, sf):
    return splits.chronological_split(_windows(spark, sf)).select(*KEY, "window_index", "start", "split")


@register("split_sizes", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, SPLIT_CTE, select=
          "SELECT split, CAST(COUNT(*) AS BIGINT) AS n_windows, CAST(COUNT(*) FILTER (WHERE active) AS BIGINT) AS n_active "
          "FROM wsplit GROUP BY split"))
def q_split_sizes(spark, sf):
    s = splits.chronological_split(_windows(spark, sf))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_windows"), F.count_if("active").alias("n_active"))


HASH = "md5('42:' || CAST(window_index AS VARCHAR))"


@register("uniform_subsample", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, select=
          f"SELECT {K}, origin_minute, window_index, active FROM wins ORDER BY {HASH}, window_index LIMIT 1000"))
def q_uniform_subsample(spark, sf):
    return splits.uniform_subsample(_stored_windows(spark, sf), 1000).select(*KEY, "origin_minute", "window_index", "active")


@register("window_lookup", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, select=
          f"SELECT {K}, group_id, window_index, CAST(start AS BIGINT) AS start FROM wins ORDER BY {HASH}, window_index LIMIT 1000"))
def q_window_lookup(spark, sf):
    """A training sample drawn from the numbers of the windows and located in the index; no window is built."""
    sparse = sparse_checkpointed(spark, sf)
    groups = win.calendar_groups(sparse).where(F.col("row_count") >= HISTORY + HORIZON)
    index = stored(win.window_index(groups), "window-index")
    n = index.agg(F.sum("n_windows")).first()[0] or 0
    return win.locate_windows(splits.sample_numbers(spark, n, 1000), index)


@register("window_lookup_all", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, select=
          f"SELECT {K}, group_id, COUNT(*) AS n_windows, CAST(SUM(start) AS BIGINT) AS starts, "
          "CAST(SUM(window_index) AS BIGINT) AS numbers FROM wins GROUP BY ALL"))
def q_window_lookup_all(spark, sf):
    """Every window number located, in buckets smaller and larger than a group's interval; both must agree."""
    sparse = sparse_checkpointed(spark, sf)
    groups = win.calendar_groups(sparse).where(F.col("row_count") >= HISTORY + HORIZON)
    index = stored(win.window_index(groups), "window-index")
    n = index.agg(F.sum("n_windows")).first()[0] or 0
    numbers = spark.range(n).select(F.col("id").alias("window_index"))
    found = (win.locate_windows(numbers, index, bucket=1000).where("window_index % 2 = 0")
             .unionByName(win.locate_windows(numbers, index).where("window_index % 2 = 1")))
    return found.groupBy(*KEY, "group_id").agg(F.count(F.lit(1)).alias("n_windows"), F.sum("start").alias("starts"),
                                               F.sum("window_index").alias("numbers"))


@register("balanced_subsample", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, """cnt AS (
  SELECT COUNT(*) FILTER (WHERE active) AS na, COUNT(*) FILTER (WHERE NOT active) AS ni FROM wins),
quota AS (
  SELECT LEAST(na, 1000 - LEAST(1000 - LEAST(CAST(ROUND_EVEN(1000 * 0.5, 0) AS BIGINT), na), ni)) AS qa,
         LEAST(1000 - LEAST(CAST(ROUND_EVEN(1000 * 0.5, 0) AS BIGINT), na), ni) AS qi FROM cnt)""", select=f"""
SELECT {K}, origin_minute, window_index, active FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY active ORDER BY {HASH}, window_index) AS rk FROM wins) w, quota
WHERE (active AND rk <= qa) OR (NOT active AND rk <= qi)"""))
def q_balanced_subsample(spark, sf):
    b = splits.balanced_subsample(_stored_windows(spark, sf), 1000, 0.5)
    return b.select(*KEY, "origin_minute", "window_index", "active")


@register("balanced_subsample_rounded", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, """cnt AS (
  SELECT COUNT(*) FILTER (WHERE active) AS na, COUNT(*) FILTER (WHERE NOT active) AS ni FROM wins),
quota AS (
  SELECT LEAST(na, 1000 - LEAST(1000 - LEAST(CAST(ROUND_EVEN(1000 * 0.1237, 0) AS BIGINT), na), ni)) AS qa,
         LEAST(1000 - LEAST(CAST(ROUND_EVEN(1000 * 0.1237, 0) AS BIGINT), na), ni) AS qi FROM cnt)""", select=f"""
SELECT {K}, origin_minute, window_index, active FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY active ORDER BY {HASH}, window_index) AS rk FROM wins) w, quota
WHERE (active AND rk <= qa) OR (NOT active AND rk <= qi)"""))
def q_balanced_subsample_rounded(spark, sf):
    """A fraction at which rounding and truncation differ (123.7 of 1000)."""
    b = splits.balanced_subsample(_stored_windows(spark, sf), 1000, 0.1237)
    return b.select(*KEY, "origin_minute", "window_index", "active")


@register("v1_split_train", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, select=
          f"SELECT window_index FROM wins ORDER BY {HASH}, window_index "
          "LIMIT (SELECT CAST(FLOOR(0.9 * COUNT(*)) AS BIGINT) FROM wins)"))
def q_v1_split_train(spark, sf):
    train, _ = splits.v1_split(_stored_windows(spark, sf))
    return train.select("window_index")


@register("v1_split_holdout", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, select=
          f"SELECT window_index FROM wins ORDER BY {HASH}, window_index "
          "OFFSET (SELECT CAST(FLOOR(0.9 * COUNT(*)) AS BIGINT) FROM wins)"))
def q_v1_split_holdout(spark, sf):
    _, rest = splits.v1_split(_stored_windows(spark, sf))
    return rest.select("window_index")


def _norm_cte() -> str:
    stats = ", ".join(f"AVG(COALESCE({c}, 0.0)) AS m_{c}, "
                      f"CASE WHEN COALESCE(STDDEV_POP(COALESCE({c}, 0.0)), 0.0) = 0 THEN 1.0 "
                      f"ELSE STDDEV_POP(COALESCE({c}, 0.0)) END AS s_{c}" for c in PAST_VALUE_FEATURES)
    rowsum = " + ".join(f"CAST(CAST((COALESCE({c}, 0.0) - m_{c}) / s_{c} AS FLOAT) AS DOUBLE)" for c in PAST_VALUE_FEATURES)
    tsum = " + ".join(f"CAST(CAST(COALESCE({c}, 0.0) AS FLOAT) AS DOUBLE)" for c in TIME_FEATURES)
    return f"""fstats AS (SELECT {stats} FROM feat),
nrows AS (
  SELECT {K}, minute, {rowsum} AS vsum, {tsum} AS tsum,
         CAST(CAST(LN(1 + CAST(requests AS DOUBLE)) AS FLOAT) AS DOUBLE) AS logt
  FROM feat, fstats
)"""


DIGEST_SQL = f"""
SELECT {K}, minute, {r('SUM(vsum) OVER p')} AS past_values_sum, {r('SUM(tsum) OVER p')} AS past_time_sum,
       {r('SUM(tsum) OVER f')} AS future_time_sum, {r('SUM(logt) OVER p')} AS past_target_sum,
       {r('SUM(logt) OVER f')} AS target_sum, COUNT(*) OVER p AS n_past, COUNT(*) OVER f AS n_future
FROM nrows
WINDOW w AS (PARTITION BY {K} ORDER BY minute),
       p AS (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW),
       f AS (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)
QUALIFY COUNT(*) OVER p = 60 AND COUNT(*) OVER f = 10"""


def array_digest(arrays):
    total = lambda c: F.aggregate(F.flatten(c), F.lit(0.0), lambda a, x: a + x)
    flat = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return arrays.select(*KEY, "minute", total("past_values").alias("past_values_sum"),
                         total("past_time").alias("past_time_sum"), total("future_time").alias("future_time_sum"),
                         flat("past_target").alias("past_target_sum"), flat("target").alias("target_sum"),
                         F.size("past_target").cast("long").alias("n_past"), F.size("target").cast("long").alias("n_future"))


@register("window_array_digest", with_ctes(*FEAT_CTES, _norm_cte(), select=DIGEST_SQL))
def q_window_array_digest(spark, sf):
    f = _features(spark, sf)
    n = win.normalise(f, win.feature_statistics(f))
    return round_doubles(array_digest(win.window_arrays(n)))


@register("selected_window_digest", with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, _norm_cte(), f"""chosen AS (
  SELECT {K}, origin_minute, window_index FROM wins ORDER BY {HASH}, window_index LIMIT 1000)""", select=f"""
SELECT c.region, c.clusterName, c.funcName, c.origin_minute, c.window_index,
       {r('SUM(CASE WHEN n.minute <= c.origin_minute THEN n.vsum ELSE 0 END)')} AS past_values_sum,
       {r('SUM(CASE WHEN n.minute <= c.origin_minute THEN n.logt ELSE 0 END)')} AS past_target_sum,
       {r('SUM(CASE WHEN n.minute > c.origin_minute THEN n.logt ELSE 0 END)')} AS target_sum
FROM chosen c JOIN nrows n ON n.region = c.region AND n.clusterName = c.clusterName AND n.funcName = c.funcName
  AND n.minute BETWEEN c.origin_minute - 59 AND c.origin_minute + 10
GROUP BY ALL"""))
def q_selected_window_digest(spark, sf):
    f = _features(spark, sf)
    n = win.normalise(f, win.feature_statistics(f))
    chosen = splits.uniform_subsample(stored(win.windows(f), "windows"), 1000)
    a = win.select_window_arrays(n, chosen)
    total = lambda c: F.aggregate(F.flatten(c), F.lit(0.0), lambda acc, x: acc + x)
    flat = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    return round_doubles(a.select(*KEY, "origin_minute", "window_index", total("past_values").alias("past_values_sum"),
                                  flat("past_target").alias("past_target_sum"), flat("target").alias("target_sum")))


@register("window_shape_violations", with_ctes(*FEAT_CTES, GROUPS_CTE, select="""
SELECT CAST(SUM(row_count - 69) AS BIGINT) AS n_windows, CAST(SUM(row_count) AS BIGINT) AS n_rows,
       CAST(SUM(69) AS BIGINT) AS n_violations, CAST(0 AS BIGINT) AS n_bad_whole FROM wgroups"""))
def q_window_shape_violations(spark, sf):
    """V10 over the arrays of every row: each group has 59 rows without a whole history and 10 without a whole
    horizon, and all others have the declared shape in every array."""
    f = _features(spark, sf)
    a = win.window_arrays(win.normalise(f, win.feature_statistics(f)), whole_only=False)
    bad = qual.window_shape_violation(n_features=len(PAST_VALUE_FEATURES), n_times=len(TIME_FEATURES))
    whole = (F.size("past_target") == 60) & (F.size("target") == 10)
    return a.agg(F.count_if(~bad).alias("n_windows"), F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(bad).alias("n_violations"), F.count_if(bad & whole).alias("n_bad_whole"))


@register("group_lookup", with_ctes(*FEAT_CTES, select=
          "SELECT minute, requests, lag_1, total_requests FROM feat "
          "WHERE region = 'R1' AND clusterName = 'c0' AND funcName = 'f0'"))
def q_group_lookup(spark, sf):
    return win.group_rows(_features(spark, sf), "R1", "c0", "f0").select("minute", "requests", "lag_1",
                                                                        "total_requests")


@register("group_lookup_bucketed", with_ctes(*FEAT_CTES, select=
          "SELECT minute, requests, lag_1, total_requests FROM feat "
          "WHERE region = 'R1' AND clusterName = 'c0' AND funcName = 'f0'"))
def q_group_lookup_bucketed(spark, sf):
    """D18 over a feature store bucketed by group: the scan reads one bucket."""
    sparse = sparse_checkpointed(spark, sf)
    table = feat.feature_table(mins.dense_calendar(sparse), group_totals=meta.group_totals(sparse))
    name = f"features_{uuid.uuid4().hex}"
    catalog.save_feature_store(table, name, scratch_table_path(spark, name), mins.dense_partitions(sparse))
    return catalog.lookup_group(spark, name, "R1", "c0", "f0").select("minute", "requests", "lag_1", "total_requests")


def _v1_cte() -> str:
    xsum = " + ".join(f"CAST(CAST(COALESCE({c}, 0.0) AS FLOAT) AS DOUBLE)" for c in V1_FEATURES)
    tsum = " + ".join(f"CAST(CAST(COALESCE({c}, 0.0) AS FLOAT) AS DOUBLE)" for c in TIME_FEATURES)
    return f"""v1rows AS (
  SELECT {K}, minute, {xsum} AS xs, {tsum} AS ts4,
         CAST(CAST(LN(1 + CAST(COALESCE(requests, 0) AS DOUBLE)) AS FLOAT) AS DOUBLE) AS logt,
         CASE category WHEN 'Rare' THEN 0 WHEN 'Normal' THEN 1 WHEN 'Hot' THEN 2 ELSE 0 END AS category_id,
         CASE stability WHEN 'Stable' THEN 0 WHEN 'Noisy' THEN 1 ELSE 0 END AS stability_id
  FROM feat
)"""


@register("v1_window_digest", with_ctes(*FEAT_CTES, _v1_cte(), select=f"""
SELECT {K}, minute, category_id, stability_id,
       {r('SUM(xs) OVER p')} AS x_sum, {r('SUM(logt) OVER f')} AS y_sum,
       {r('SUM(ts4) OVER p')} AS past_time_sum, {r('10 * ts4')} AS future_time_sum,
       COUNT(*) OVER p AS n_x, COUNT(*) OVER f AS n_y
FROM v1rows
WINDOW w AS (PARTITION BY {K} ORDER BY minute),
       p AS (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW),
       f AS (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)
QUALIFY COUNT(*) OVER p = 60 AND COUNT(*) OVER f = 10"""))
def q_v1_window_digest(spark, sf):
    """D10 samples and the D11 adapter (stale future time), summarised per window."""
    s = win.v1_adapter(win.v1_samples(_features(spark, sf)))
    total = lambda c: F.aggregate(F.flatten(c), F.lit(0.0), lambda acc, x: acc + x)
    flat = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    return round_doubles(s.select(*KEY, "minute", "category_id", "stability_id", total("x").alias("x_sum"),
                                  flat("y").alias("y_sum"), total("past_time").alias("past_time_sum"),
                                  total("future_time").alias("future_time_sum"),
                                  F.size("x").cast("long").alias("n_x"), F.size("y").cast("long").alias("n_y")))
