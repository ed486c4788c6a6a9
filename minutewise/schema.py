"""Column contracts and the fixed values the trace data model depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# Group key of every per-function time series: (region, clusterName, funcName).
KEY = ["region", "clusterName", "funcName"]

# Raw invocation record as declared for CSV ingest (schema is declared, never inferred).
TRACE_SCHEMA = T.StructType([
    T.StructField("time_worker", T.DoubleType()),
    T.StructField("time_frontend", T.DoubleType()),
    T.StructField("clusterName", T.StringType()),
    T.StructField("funcName", T.StringType()),
    T.StructField("podID", T.StringType()),
    T.StructField("userID", T.StringType()),
    T.StructField("cpu_usage", T.DoubleType()),
    T.StructField("memory_usage", T.DoubleType()),
    T.StructField("runtimeCost", T.DoubleType()),
    T.StructField("requestBodySize", T.DoubleType()),
])

# Optional cost columns of the raw trace (mean per minute, 0.0 when absent).
COST_COLUMNS = {
    "workerCost": "avg_worker_cost",
    "frontendCost": "avg_frontend_cost",
    "busCost": "avg_bus_cost",
    "readBodyCost": "avg_read_body_cost",
    "writeRspCost": "avg_write_rsp_cost",
    "totalCost_worker": "avg_total_cost_worker",
    "totalCost_frontend": "avg_total_cost_frontend",
}

# Columns of the minute tables (sparse and dense share them).
MINUTE_COLUMNS = ["minute", *KEY, "requests", "avg_cpu", "avg_memory", "avg_runtime",
                  "avg_request_size", "active_pods", "active_users"]

# ---- Fixed values (must equal the reference for identical results) ----------------------
# Forecast window shape.
HISTORY = 60
HORIZON = 10
WARM_LOOKBACK = 30
# Chronological split fractions and the sampling seed.
TRAIN_FRACTION = 0.80
VALID_FRACTION = 0.10
TEST_FRACTION = 0.10
SEED = 42
# Bounds of the log-space spread of the forecast distribution.
MIN_LOG_SIGMA = 0.05
MAX_LOG_SIGMA = 1.00
# Scale of the request-count MAE term of the hurdle loss.
REQUEST_MAE_LOSS_SCALE = 1000.0
# Past-value features of a forecast window, in order.
PAST_VALUE_FEATURES = [
    "requests", "avg_cpu", "avg_memory", "avg_runtime", "avg_request_size", "active_pods",
    "active_users", "lag_1", "lag_5", "lag_15", "lag_30", "rolling_mean_5", "rolling_mean_15",
    "rolling_mean_30", "rolling_std", "rolling_max", "rolling_min", "rolling_median",
    "warm_capacity", "trend", "growth_rate", "coeff_variation", "cpu_per_request",
    "memory_per_request", "runtime_per_request", "warm_ratio",
]
# Cyclic time features, in order.
TIME_FEATURES = ["hour_sin", "hour_cos", "minute_sin", "minute_cos"]
# The first model version uses one list: past values followed by the time features.
V1_FEATURES = PAST_VALUE_FEATURES + TIME_FEATURES
# Integer codes of the function classes.
CATEGORY_CODES = {"Rare": 0, "Normal": 1, "Hot": 2}
STABILITY_CODES = {"Stable": 0, "Noisy": 1}
# Raw time columns, in order of preference.
RAW_TIME_COLUMNS = ("time_worker", "time_frontend")
# ------------------------------------------------------------------------------------------

# Minimum rows a group needs for one forecast window.
WINDOW_ROWS = HISTORY + HORIZON
