"""A distributed hurdle forecaster with Spark ML (re-aims the reference's transformer).

Rows are (window origin, horizon step). Inputs: the z-scored past-value features at the origin,
the cyclic time features of the target minute and the step. Outputs follow the prediction
contract (K, origin_minute, step, target_log, last_log, mu, sigma, p):

* p — ``LogisticRegression`` on demand occurrence (target > 0);
* mu — last_log + ``LinearRegression`` of (target_log − last_log), fitted on positive rows;
* sigma — per-group std of the positive-row residuals, clipped to [0.05, 1]; groups without
  positive training rows get the pooled residual std (clipped).

Fitting uses the training split only; both learners run as distributed tree aggregations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutewise.operators.splits import split_bounds
from minutewise.schema import HISTORY, HORIZON, KEY, MAX_LOG_SIGMA, MIN_LOG_SIGMA, PAST_VALUE_FEATURES


def step_rows(normalised: DataFrame, features: list[str] = PAST_VALUE_FEATURES, history: int = HISTORY,
              horizon: int = HORIZON) -> DataFrame:
    """One row per (origin, step) with origin features, target-minute time features, targets
    and the chronological split label of the window (D13).

    Built in the group window pass (``lead`` for the horizon) and one ``posexplode``.
    """
    w = Window.partitionBy(*KEY).orderBy("minute")
    r = F.col("raw_target")
    fut = F.array(*[F.struct(F.log1p(F.lead(r, s).over(w)).alias("target_log"),
                             (F.lead("minute", s).over(w)).alias("tm")) for s in range(1, horizon + 1)])
    base = normalised.select(
        *KEY, "minute", *features,
        F.row_number().over(w).alias("_i"),
        F.count(F.lit(1)).over(Window.partitionBy(*KEY)).alias("_n"),
        F.log1p(r).alias("last_log"),
        fut.alias("_fut"))
    base = base.where((F.col("_i") >= history) & (F.col("_i") <= F.col("_n") - horizon))
    n_windows = F.col("_n") - (history + horizon) + 1
    start = F.col("_i") - history
    train_end, val_end = split_bounds(n_windows)
    split = F.when(start < train_end, "train").when(start < val_end, "validation").otherwise("test")
    ex = base.select(*KEY, F.col("minute").alias("origin_minute"), *features, "last_log", split.alias("split"),
                     F.posexplode("_fut").alias("_s", "_f"))
    tm = F.col("_f.tm")
    hod = (F.floor(tm / 60.0) % 24).cast("double")
    moh = (tm % 60).cast("double")
    two_pi = 6.283185307179586
    return ex.select(
        *KEY, "origin_minute", (F.col("_s") + 1).cast("int").alias("step"), "split", *features, "last_log",
        F.col("_f.target_log").alias("target_log"),
        F.sin(F.lit(two_pi) * hod / 24.0).alias("f_hour_sin"), F.cos(F.lit(two_pi) * hod / 24.0).alias("f_hour_cos"),
        F.sin(F.lit(two_pi) * moh / 60.0).alias("f_minute_sin"),
        F.cos(F.lit(two_pi) * moh / 60.0).alias("f_minute_cos"))


@dataclass
class HurdleModel:
    occurrence: LogisticRegressionModel
    residual: LinearRegressionModel
    sigma_by_group: DataFrame
    pooled_sigma: float
    inputs: list[str]


def model_inputs(features: list[str] = PAST_VALUE_FEATURES) -> list[str]:
    return [*features, "last_log", "step_d", "f_hour_sin", "f_hour_cos", "f_minute_sin", "f_minute_cos"]


def _assemble(rows: DataFrame, inputs: list[str]) -> DataFrame:
    rows = rows.withColumn("step_d", F.col("step").cast("double"))
    return VectorAssembler(inputCols=inputs, outputCol="x", handleInvalid="keep").transform(rows)


def fit_hurdle(train_rows: DataFrame, features: list[str] = PAST_VALUE_FEATURES, reg: float = 1e-4,
               limit: int = 1000) -> HurdleModel:
    """Fit occurrence and positive-residual models on the training rows.

    The tolerance ends the logistic fit; one that has not converged within ``limit`` iterations is an error."""
    inputs = model_inputs(features)
    data = _assemble(train_rows, inputs).withColumn("occ", (F.col("target_log") > 0).cast("double"))
    occ = LogisticRegression(featuresCol="x", labelCol="occ", maxIter=limit, regParam=reg).fit(data)
    if occ.summary.totalIterations >= limit:
        raise RuntimeError(f"the occurrence model has not converged after {limit} iterations")
    pos = data.where("target_log > 0").withColumn("res", F.col("target_log") - F.col("last_log"))
    lin = LinearRegression(featuresCol="x", labelCol="res", regParam=reg, solver="normal").fit(pos)
    resid = lin.transform(pos).withColumn("e", F.col("res") - F.col("prediction"))
    clip = lambda c: F.least(F.greatest(c, F.lit(MIN_LOG_SIGMA)), F.lit(MAX_LOG_SIGMA))
    by_group = resid.groupBy(*KEY).agg(clip(F.coalesce(F.stddev_samp("e"), F.lit(MIN_LOG_SIGMA))).alias("sigma"))
    pooled = resid.agg(F.stddev_samp("e")).first()[0]
    pooled = float(min(max(pooled if pooled is not None else MIN_LOG_SIGMA, MIN_LOG_SIGMA), MAX_LOG_SIGMA))
    return HurdleModel(occ, lin, by_group, pooled, inputs)


def score(model: HurdleModel, rows: DataFrame) -> DataFrame:
    """Predictions for every (origin, step) row of ``rows``."""
    x = _assemble(rows, model.inputs)
    p = model.occurrence.transform(x).select(
        *KEY, "origin_minute", "step", "target_log", "last_log", "x",
        vector_to_array("probability")[1].alias("p"))
    mu = model.residual.transform(p).withColumn("mu", F.col("last_log") + F.col("prediction"))
    # names of its own: fitted and scored rows may come from one table, so their columns are told apart by name
    sig = model.sigma_by_group.select(*[F.col(k).alias(f"_g_{k}") for k in KEY], "sigma")
    out = mu.join(sig, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in KEY], "left")
    return out.select(*KEY, "origin_minute", "step", "target_log", "last_log", "mu",
                      F.coalesce(F.col("sigma"), F.lit(model.pooled_sigma)).alias("sigma"), "p")
