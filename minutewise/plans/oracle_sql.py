"""Independent DuckDB SQL twins of the registered queries (the correctness oracle).

Written from the operator definitions with DuckDB's own functions (median, quantile_cont,
range, ...), not by translating the Spark code. The driver registers only the base tables, so
every statement inlines the trace mapping as its first CTE. Doubles are rounded to 6 digits on
both sides; counts are cast to BIGINT (DuckDB sums are HUGEINT).
"""

from __future__ import annotations

from minutewise.sources.fixture import TRACE_CTE_SQL


def r(expr: str, digits: int = 6) -> str:
    """Same rounding expression as ``numeric.stable_round`` (floor with an off-tie half point)."""
    scale = f"{float(10 ** digits)!r}"
    return f"(FLOOR(CAST({expr} AS DOUBLE) * {scale} + 0.5000271828) / {scale})"


def sparse_cte(bucket: int = 60, name: str = "sparse") -> str:
    return f"""{name} AS (
  SELECT CAST(FLOOR(time_worker / {bucket}) AS INTEGER) AS minute, region, clusterName, funcName,
         CAST(COUNT(*) AS BIGINT) AS requests,
         AVG(cpu_usage) AS avg_cpu, AVG(memory_usage) AS avg_memory, AVG(runtimeCost) AS avg_runtime,
         AVG(requestBodySize) AS avg_request_size,
         CAST(COUNT(DISTINCT podID) AS BIGINT) AS active_pods,
         CAST(COUNT(DISTINCT userID) AS BIGINT) AS active_users
  FROM trace
  GROUP BY 1, region, clusterName, funcName
)"""


def dense_cte(src: str = "sparse", name: str = "dense") -> str:
    return f"""{name}_bounds AS (SELECT MIN(minute) AS lo, MAX(minute) AS hi FROM {src}),
{name}_groups AS (SELECT DISTINCT region, clusterName, funcName FROM {src}),
{name}_cal AS (SELECT CAST(c.range AS INTEGER) AS minute FROM {name}_bounds b, range(b.lo, b.hi + 1) c),
{name} AS (
  SELECT g.region, g.clusterName, g.funcName, c.minute,
         CAST(COALESCE(s.requests, 0) AS BIGINT) AS requests,
         COALESCE(s.avg_cpu, 0.0) AS avg_cpu, COALESCE(s.avg_memory, 0.0) AS avg_memory,
         COALESCE(s.avg_runtime, 0.0) AS avg_runtime, COALESCE(s.avg_request_size, 0.0) AS avg_request_size,
         CAST(COALESCE(s.active_pods, 0) AS BIGINT) AS active_pods,
         CAST(COALESCE(s.active_users, 0) AS BIGINT) AS active_users
  FROM {name}_groups g CROSS JOIN {name}_cal c
  LEFT JOIN {src} s ON s.region IS NOT DISTINCT FROM g.region AND s.clusterName IS NOT DISTINCT FROM g.clusterName
       AND s.funcName IS NOT DISTINCT FROM g.funcName AND s.minute = c.minute
)"""


def meta_cte(src: str = "dense", name: str = "meta") -> str:
    return f"""{name}_stats AS (
  SELECT region, clusterName, funcName, CAST(SUM(requests) AS BIGINT) AS total_requests,
         AVG(avg_cpu) AS avg_cpu, AVG(avg_memory) AS avg_memory, AVG(avg_runtime) AS avg_runtime,
         STDDEV_SAMP(requests) AS std_requests, AVG(requests) AS mean_requests
  FROM {src} GROUP BY region, clusterName, funcName
),
{name}_q AS (
  SELECT quantile_cont(total_requests, 0.80) AS q_hot, quantile_cont(total_requests, 0.25) AS q_rare
  FROM {name}_stats
),
{name} AS (
  SELECT s.*,
         CASE WHEN s.total_requests >= q.q_hot THEN 'Hot'
              WHEN s.total_requests <= q.q_rare THEN 'Rare' ELSE 'Normal' END AS category,
         CASE WHEN s.mean_requests = 0 THEN 'Noisy'
              WHEN s.std_requests / s.mean_requests > 1 THEN 'Noisy' ELSE 'Stable' END AS stability
  FROM {name}_stats s, {name}_q q
)"""


def features_cte(src: str = "dense", meta: str | None = "meta", name: str = "feat", std: str = "STDDEV_SAMP",
                 zero_div: str = "null") -> str:
    w = "PARTITION BY region, clusterName, funcName ORDER BY minute"
    def fr(n: int) -> str:
        return f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    join = (f"LEFT JOIN {meta} m ON b.region IS NOT DISTINCT FROM m.region AND b.clusterName IS NOT DISTINCT FROM "
            f"m.clusterName AND b.funcName IS NOT DISTINCT FROM m.funcName") if meta else ""
    meta_cols = ("m.category, m.stability, m.total_requests" if meta else
                 "CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS stability, "
                 "CAST(NULL AS BIGINT) AS total_requests")
    if zero_div == "null":
        growth = "CASE WHEN COALESCE(b.lag_1, 0) = 0 THEN 0.0 ELSE (b.requests - b.lag_1) / b.lag_1 END"
        cv = "CASE WHEN b.rolling_mean_30 = 0 THEN 0.0 ELSE b.rolling_std / b.rolling_mean_30 END"
        per = lambda x: f"b.avg_{x} / NULLIF(b.requests, 0)"
        wr = "CASE WHEN b.warm_capacity = 0 THEN 0.0 ELSE b.requests / b.warm_capacity END"
    else:
        growth = ("CASE WHEN b.lag_1 IS NULL OR b.lag_1 = 0 THEN 0.0 "
                  "ELSE (b.requests - b.lag_1) / b.lag_1 END")
        cv = ("CASE WHEN b.rolling_std IS NULL OR b.rolling_mean_30 = 0 THEN 0.0 "
              "ELSE b.rolling_std / b.rolling_mean_30 END")
        per = lambda x: f"CASE WHEN b.requests = 0 THEN 0.0 ELSE b.avg_{x} / b.requests END"
        wr = "CASE WHEN b.warm_capacity = 0 OR b.warm_capacity IS NULL THEN 0.0 ELSE b.requests / b.warm_capacity END"
    return f"""{name}_base AS (
  SELECT *,
    LAG(requests, 1) OVER ({w}) AS lag_1, LAG(requests, 5) OVER ({w}) AS lag_5,
    LAG(requests, 15) OVER ({w}) AS lag_15, LAG(requests, 30) OVER ({w}) AS lag_30,
    AVG(requests) OVER {fr(5)} AS rolling_mean_5, AVG(requests) OVER {fr(15)} AS rolling_mean_15,
    AVG(requests) OVER {fr(30)} AS rolling_mean_30,
    {std}(requests) OVER {fr(30)} AS rolling_std,
    MAX(requests) OVER {fr(30)} AS rolling_max, MIN(requests) OVER {fr(30)} AS rolling_min,
    MEDIAN(requests) OVER {fr(30)} AS rolling_median,
    QUANTILE_CONT(requests, 0.9) OVER {fr(30)} AS warm_capacity
  FROM {src}
),
{name} AS (
  SELECT b.*, {meta_cols},
    b.requests - COALESCE(b.lag_1, b.requests) AS trend,
    {growth} AS growth_rate,
    {cv} AS coeff_variation,
    {per('cpu')} AS cpu_per_request, {per('memory')} AS memory_per_request,
    {per('runtime')} AS runtime_per_request,
    {wr} AS warm_ratio,
    CAST(b.minute % 60 AS INTEGER) AS minute_of_hour,
    CAST(FLOOR(b.minute / 60) % 24 AS INTEGER) AS hour_of_day,
    SIN(2 * PI() * (FLOOR(b.minute / 60) % 24) / 24.0) AS hour_sin,
    COS(2 * PI() * (FLOOR(b.minute / 60) % 24) / 24.0) AS hour_cos,
    SIN(2 * PI() * (b.minute % 60) / 60.0) AS minute_sin,
    COS(2 * PI() * (b.minute % 60) / 60.0) AS minute_cos
  FROM {name}_base b {join}
)"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([TRACE_CTE_SQL, *ctes]) + "\n" + select


# ---- normal distribution in DuckDB SQL (no erf / ndtri there) ------------------------------

def _lit(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _horner_sql(coeffs: list[float], x: str) -> str:
    acc = _lit(coeffs[0])
    for c in coeffs[1:]:
        acc = f"({acc} * {x} + {_lit(c)})"
    return acc


def sql_norm_cdf(x: str) -> str:
    from minutewise.functions import normal as N
    ax = f"ABS({x})"
    e = f"EXP(-{ax} * {ax} / 2.0)"
    central = f"({e} * {_horner_sql(N.HART_NUM, ax)} / {_horner_sql(N.HART_DEN, ax)})"
    frac = f"({ax} + 0.65)"
    for k in (4.0, 3.0, 2.0, 1.0):
        frac = f"({ax} + {k} / {frac})"
    tail = f"({e} / {frac} / {_lit(N.SQRT_2PI)})"
    lower = (f"(CASE WHEN {ax} > {N.HART_TAIL_LIMIT} THEN 0.0 WHEN {ax} < {_lit(N.HART_SPLIT)} THEN {central} "
             f"ELSE {tail} END)")
    return f"(CASE WHEN {x} > 0 THEN 1.0 - {lower} ELSE {lower} END)"


def sql_acklam(p: str) -> str:
    from minutewise.functions import normal as N
    qlo = f"SQRT(-2.0 * LN({p}))"
    qhi = f"SQRT(-2.0 * LN(1.0 - {p}))"
    lo = f"({_horner_sql(N.ACKLAM_C, qlo)} / ({_horner_sql(N.ACKLAM_D, qlo)} * {qlo} + 1.0))"
    hi = f"(-{_horner_sql(N.ACKLAM_C, qhi)} / ({_horner_sql(N.ACKLAM_D, qhi)} * {qhi} + 1.0))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    mid = f"({_horner_sql(N.ACKLAM_A, r)} * {q} / ({_horner_sql(N.ACKLAM_B, r)} * {r} + 1.0))"
    return f"(CASE WHEN {p} < {N.ACKLAM_P_LOW} THEN {lo} WHEN {p} > {1 - N.ACKLAM_P_LOW!r} THEN {hi} ELSE {mid} END)"


def sql_halley(x: str, p: str) -> str:
    import math
    u = f"(({sql_norm_cdf(x)} - {p}) * {_lit(math.sqrt(2 * math.pi))} * EXP({x} * {x} / 2.0))"
    return f"({x} - {u} / (1.0 + {x} * {u} / 2.0))"


PRED_BASE_CTE = """pred_base AS (
  SELECT region, clusterName, funcName, minute,
    ROW_NUMBER() OVER w AS i,
    COUNT(*) OVER (PARTITION BY region, clusterName, funcName) AS n,
    LN(1 + CAST(requests AS DOUBLE)) AS last_log,
    LN(1 + AVG(requests) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) + 0.5 AS mu,
    STDDEV_SAMP(requests) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sd30,
    COUNT(*) FILTER (WHERE requests > 0) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS act30,
    COALESCE(QUANTILE_CONT(CASE WHEN requests > 0 THEN CAST(requests AS DOUBLE) END, 0.9)
             OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0.0) AS warm_capacity,
    [LEAD(requests, 1) OVER w, LEAD(requests, 2) OVER w, LEAD(requests, 3) OVER w, LEAD(requests, 4) OVER w,
     LEAD(requests, 5) OVER w, LEAD(requests, 6) OVER w, LEAD(requests, 7) OVER w, LEAD(requests, 8) OVER w,
     LEAD(requests, 9) OVER w, LEAD(requests, 10) OVER w] AS fut
  FROM dense
  WINDOW w AS (PARTITION BY region, clusterName, funcName ORDER BY minute)
)"""


def preds_cte(flip_p: bool = False, name: str = "preds") -> str:
    p = "(act30 + 1) / 32.0"
    if flip_p:
        p = f"1.0 - {p}"
    return f"""{name} AS (
  SELECT region, clusterName, funcName, minute AS origin_minute, CAST(s.range AS INTEGER) AS step,
    LN(1 + CAST(fut[s.range] AS DOUBLE)) AS target_log, last_log, mu,
    0.05 + 0.95 * sd30 / (1 + sd30) AS sigma, {p} AS p, warm_capacity
  FROM pred_base, range(1, 11) s
  WHERE i >= 60 AND i <= n - 10
)"""
