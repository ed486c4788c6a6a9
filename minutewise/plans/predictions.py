"""Deterministic prediction table derived from the dense series (input for hurdle maths and metrics).

Per group of the dense calendar (r = requests, i = 1-based row, n = rows) every origin with
i ≥ 60 and i ≤ n − 10, steps 1..10:
  target_log = ln(1 + r at origin+step), last_log = ln(1 + r at origin),
  mu = ln(1 + mean of the last 5) + 0.5, sigma = 0.05 + 0.95·sd30/(1 + sd30) (sample sd, 30 rows),
  p = (active minutes among the last 30 + 1)/32, or 1 − that (``flip_p``) so both hurdle branches occur;
  warm_capacity = P5 over the last 30 rows.
All columns come from one Window operator over the group partitioning, then one explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutewise.operators.hurdle import history_capacity
from minutewise.schema import HISTORY, HORIZON, KEY


def synthetic_predictions(dense: DataFrame, flip_p: bool = False, history: int = HISTORY,
                          horizon: int = HORIZON) -> DataFrame:
    w = Window.partitionBy(*KEY).orderBy("minute")
    r = F.col("requests").cast("double")
    last5 = w.rowsBetween(-4, 0)
    last30 = w.rowsBetween(-29, 0)
    sd30 = F.stddev_samp(r).over(last30)
    active30 = F.count_if(r > 0).over(last30)
    p = (active30 + 1) / F.lit(32.0)
    base = dense.select(
        *KEY, "minute",
        F.row_number().over(w).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(*KEY)).alias("n"),
        F.log1p(r).alias("last_log"),
        (F.log1p(F.avg(r).over(last5)) + F.lit(0.5)).alias("mu"),
        (F.lit(0.05) + F.lit(0.95) * sd30 / (F.lit(1.0) + sd30)).alias("sigma"),
        (F.lit(1.0) - p if flip_p else p).alias("p"),
        history_capacity("requests").alias("warm_capacity"),
        F.array(*[F.log1p(F.lead(r, s).over(w)) for s in range(1, horizon + 1)]).alias("_future"),
    )
    origins = base.where((F.col("i") >= history) & (F.col("i") <= F.col("n") - horizon))
    return origins.select(
        *KEY, F.col("minute").alias("origin_minute"),
        F.posexplode("_future").alias("_s", "target_log"),
        "last_log", "mu", "sigma", "p", "warm_capacity",
    ).select(*KEY, "origin_minute", (F.col("_s") + 1).cast("int").alias("step"), "target_log", "last_log",
             "mu", "sigma", "p", "warm_capacity")
