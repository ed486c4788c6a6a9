"""Forecast metrics as single-pass aggregates over a predictions table.

Columns used: mu, sigma, p, target_log, last_log (log1p space). Request-space target is
max(expm1(target_log), 0); the persistence forecast is expm1(last_log).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutewise.operators.hurdle import hurdle_mean, with_hurdle_quantiles
from minutewise.schema import KEY, REQUEST_MAE_LOSS_SCALE


def _target() -> Column:
    return F.greatest(F.expm1("target_log"), F.lit(0.0))


def errors(predictions: DataFrame) -> DataFrame:
    """Per row: median error (q50), mean error (hurdle mean), persistence error, target."""
    t = _target()
    q = with_hurdle_quantiles(predictions, {"_q50": 0.5})
    return q.select(
        *predictions.columns,
        (F.col("_q50") - t).alias("e_median"),
        (hurdle_mean("mu", "sigma", "p") - t).alias("e_mean"),
        (F.expm1("last_log") - t).alias("e_base"),
        t.alias("target"),
    )


def forecast_metrics(predictions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M1–M5 in one aggregate: mae, rmse, base_mae, base_rmse, improvement_pct, precision,
    recall, f1 (occurrence predicted at p ≥ threshold)."""
    e = errors(predictions)
    pred_act = F.col("p") >= threshold
    act = F.col("target") > 0
    a = e.agg(
        F.avg(F.abs("e_median")).alias("mae"),
        F.sqrt(F.avg(F.col("e_mean") * F.col("e_mean"))).alias("rmse"),
        F.avg(F.abs("e_base")).alias("base_mae"),
        F.sqrt(F.avg(F.col("e_base") * F.col("e_base"))).alias("base_rmse"),
        F.count_if(pred_act & act).alias("tp"),
        F.count_if(pred_act).alias("pp"),
        F.count_if(act).alias("ap"),
    )
    precision = F.col("tp") / F.greatest(F.col("pp"), F.lit(1))
    recall = F.col("tp") / F.greatest(F.col("ap"), F.lit(1))
    return a.select(
        "mae", "rmse", "base_mae", "base_rmse",
        ((F.lit(1.0) - F.try_divide(F.col("mae"), F.col("base_mae"))) * 100.0).alias("improvement_pct"),
        precision.alias("precision"), recall.alias("recall"),
        (F.lit(2.0) * precision * recall / F.greatest(precision + recall, F.lit(1e-12))).alias("f1"),
    )


def demand_class_mae(predictions: DataFrame) -> DataFrame:
    """M6: MAE vs persistence on zero-demand and on active-demand rows (absent class → no row);
    improvement NULL when the persistence MAE is 0."""
    e = errors(predictions)
    cls = F.when(F.col("target") > 0, "active demand").otherwise("zero demand")
    g = e.groupBy(cls.alias("demand_class")).agg(F.avg(F.abs("e_median")).alias("mae"),
                                                  F.avg(F.abs("e_base")).alias("base_mae"))
    return g.withColumn("improvement_pct",
                        F.when(F.col("base_mae") != 0, (F.lit(1.0) - F.col("mae") / F.col("base_mae")) * 100.0))


def hurdle_loss(predictions: DataFrame) -> DataFrame:
    """M7: BCE(occurrence) + mean(½z² + ln σ) on active rows + MAE(expm1 mu, expm1 t)/1000 on
    active rows; active parts are 0 when no row is active. BCE is the stable logit form."""
    p = F.least(F.greatest(F.col("p"), F.lit(1e-12)), F.lit(1 - 1e-12))
    logit = F.log(p / (F.lit(1.0) - p))
    y = (F.col("target_log") > 0).cast("double")
    bce = F.greatest(logit, F.lit(0.0)) - logit * y + F.log1p(F.exp(-F.abs(logit)))
    act = F.col("target_log") > 0
    z = (F.col("target_log") - F.col("mu")) / F.col("sigma")
    nll = F.lit(0.5) * z * z + F.log("sigma")
    mae = F.abs(F.greatest(F.expm1("mu"), F.lit(0.0)) - F.greatest(F.expm1("target_log"), F.lit(0.0)))
    a = predictions.agg(F.avg(bce).alias("bce"),
                        F.coalesce(F.avg(F.when(act, nll)), F.lit(0.0)).alias("count_nll"),
                        F.coalesce(F.avg(F.when(act, mae)), F.lit(0.0)).alias("request_mae"))
    return a.withColumn("loss", F.col("bce") + F.col("count_nll") + F.col("request_mae") / REQUEST_MAE_LOSS_SCALE)


def mse_loss(predictions: DataFrame) -> DataFrame:
    """M8: mean squared error of mu against target_log."""
    e = F.col("mu") - F.col("target_log")
    return predictions.agg(F.avg(e * e).alias("mse"))


def pinball_loss(predictions: DataFrame, q: float = 0.5) -> DataFrame:
    """M9: mean(max(q·e, (q − 1)·e)), e = target_log − mu."""
    e = F.col("target_log") - F.col("mu")
    return predictions.agg(F.avg(F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e)).alias("pinball"))


def per_sample_scores(predictions: DataFrame) -> DataFrame:
    """Per window (group, origin) MAE, RMSE and R² of the hurdle mean in request space;
    R² is NULL for a constant target."""
    t = _target()
    pred = hurdle_mean("mu", "sigma", "p")
    e = pred - t
    w = Window.partitionBy(*KEY, "origin_minute")
    x = predictions.select(*KEY, "origin_minute", e.alias("e"), t.alias("t"))
    x = x.withColumn("t_mean", F.avg("t").over(w))
    g = x.groupBy(*KEY, "origin_minute").agg(
        F.avg(F.abs("e")).alias("mae"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        F.sum(F.col("e") * F.col("e")).alias("_sse"),
        F.sum((F.col("t") - F.col("t_mean")) * (F.col("t") - F.col("t_mean"))).alias("_sst"))
    return g.select(*KEY, "origin_minute", "mae", "rmse",
                    F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"))


def best_epoch(log: DataFrame, run: str = "run", epoch: str = "epoch", metric: str = "validation_mae") -> DataFrame:
    """Per run the epoch with the least validation metric (ties → earliest epoch)."""
    return log.groupBy(run).agg(
        F.min_by(F.col(epoch), F.struct(F.col(metric), F.col(epoch))).alias("best_epoch"),
        F.min(metric).alias(f"best_{metric}"))
