"""Registered queries: hurdle forecast maths (P1–P8) and forecast metrics (M1–M11) over the
deterministic prediction table derived from the dense series (all groups, all origins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from minutewise.functions.numeric import round_doubles
from minutewise.operators import hurdle, metrics
from minutewise.plans.oracle_sql import (PRED_BASE_CTE, dense_cte, preds_cte, r, sparse_cte, sql_acklam,
                                         sql_halley, sql_norm_cdf, with_ctes)
from minutewise.plans.predictions import synthetic_predictions
from minutewise.plans.q_minutes import dense_checkpointed
from minutewise.plans.registry import register
from minutewise.schema import KEY

K = ", ".join(KEY)


def _preds(spark, sf, flip=False):
    return synthetic_predictions(dense_checkpointed(spark, sf), flip_p=flip)


def _pred_ctes(flip: bool) -> list[str]:
    return [sparse_cte(), dense_cte(), PRED_BASE_CTE, preds_cte(flip)]


def _record_sql(flip: bool) -> str:
    qs = {"10": 0.1, "50": 0.5, "90": 0.9}
    fr = [
        "fr1 AS (SELECT *, LEAST(GREATEST(p, 1e-6), 1.0 - 1e-6) AS pc FROM preds)",
        "fr2 AS (SELECT *, " + ", ".join(f"({q} - (1.0 - pc)) / pc AS c{k}" for k, q in qs.items()) + " FROM fr1)",
        "fr3 AS (SELECT *, " + ", ".join(f"LEAST(GREATEST(c{k}, 1e-6), 1.0 - 1e-6) AS k{k}" for k in qs) + " FROM fr2)",
        "fr4 AS (SELECT *, " + ", ".join(f"{sql_acklam(f'k{k}')} AS a{k}" for k in qs) + " FROM fr3)",
        "fr5 AS (SELECT *, " + ", ".join(f"{sql_halley(f'a{k}', f'k{k}')} AS z{k}" for k in qs) + " FROM fr4)",
        "fr6 AS (SELECT *, p * (EXP(mu + 0.5 * sigma * sigma) - 1) AS mean_u FROM fr5)",
    ]
    quant = ", ".join(f"{r(f'CASE WHEN c{k} > 0 THEN GREATEST(0.0, EXP(mu + sigma * z{k}) - 1) ELSE 0.0 END')} AS q{k}"
                      for k in qs)
    risk = f"p * (1.0 - {sql_norm_cdf('((LN(1 + warm_capacity) - mu) / GREATEST(sigma, 1e-6))')})"
    std = "SQRT(GREATEST(p * (EXP(2.0 * mu + 2.0 * sigma * sigma) - 2.0 * EXP(mu + 0.5 * sigma * sigma) + 1.0) - mean_u * mean_u, 1e-12))"
    select = (f"SELECT {K}, origin_minute, step, {r('mean_u')} AS mean, {r(std)} AS std, {quant}, "
              f"{r(risk)} AS cold_start_risk, {r('warm_capacity')} AS warm_capacity FROM fr6")
    return with_ctes(*_pred_ctes(flip), *fr, select=select)


@register("forecast_record", _record_sql(False))
def q_forecast_record(spark, sf):
    return round_doubles(hurdle.forecast_record(_preds(spark, sf)))


@register("forecast_record_flipped", _record_sql(True))
def q_forecast_record_flipped(spark, sf):
    return round_doubles(hurdle.forecast_record(_preds(spark, sf, True)))


LOGNORMAL_SQL = with_ctes(*_pred_ctes(False), select=f"""
SELECT {K}, origin_minute, step, {r('EXP(mu + 0.5 * sigma * sigma) - 1.0')} AS mean,
  {r('SQRT(GREATEST((EXP(sigma * sigma) - 1.0) * EXP(2.0 * mu + sigma * sigma), 1e-12))')} AS std,
  {r('GREATEST(0.0, EXP(mu + -1.281551565545 * sigma) - 1)')} AS q10,
  {r('GREATEST(0.0, EXP(mu + 0.0 * sigma) - 1)')} AS q50,
  {r('GREATEST(0.0, EXP(mu + 1.281551565545 * sigma) - 1)')} AS q90
FROM preds""")


@register("lognormal_record", LOGNORMAL_SQL)
def q_lognormal_record(spark, sf):
    return round_doubles(hurdle.lognormal_record(_preds(spark, sf)))


@register("persistence_forecast", with_ctes(*_pred_ctes(False), select=
          f"SELECT {K}, origin_minute, step, {r('EXP(last_log) - 1')} AS forecast FROM preds"))
def q_persistence_forecast(spark, sf):
    return round_doubles(hurdle.persistence(_preds(spark, sf)))


def _errors_cte(flip: bool) -> list[str]:
    from minutewise.plans.oracle_sql import sql_acklam as ack
    return _pred_ctes(flip) + [
        "e1 AS (SELECT *, LEAST(GREATEST(p, 1e-6), 1.0 - 1e-6) AS pc FROM preds)",
        "e2 AS (SELECT *, (0.5 - (1.0 - pc)) / pc AS c50 FROM e1)",
        "e3 AS (SELECT *, LEAST(GREATEST(c50, 1e-6), 1.0 - 1e-6) AS k50 FROM e2)",
        f"e4 AS (SELECT *, {ack('k50')} AS a50 FROM e3)",
        f"e5 AS (SELECT *, {sql_halley('a50', 'k50')} AS z50 FROM e4)",
        """errs AS (SELECT *, GREATEST(EXP(target_log) - 1, 0.0) AS target,
             (CASE WHEN c50 > 0 THEN GREATEST(0.0, EXP(mu + sigma * z50) - 1) ELSE 0.0 END)
               - GREATEST(EXP(target_log) - 1, 0.0) AS e_median,
             p * GREATEST(EXP(mu + 0.5 * sigma * sigma) - 1, 0.0) - GREATEST(EXP(target_log) - 1, 0.0) AS e_mean,
             (EXP(last_log) - 1) - GREATEST(EXP(target_log) - 1, 0.0) AS e_base
           FROM e5)""",
    ]


def _metrics_sql(flip: bool) -> str:
    return with_ctes(*_errors_cte(flip), """m AS (
  SELECT AVG(ABS(e_median)) AS mae, SQRT(AVG(e_mean * e_mean)) AS rmse, AVG(ABS(e_base)) AS base_mae,
         SQRT(AVG(e_base * e_base)) AS base_rmse,
         COUNT(*) FILTER (WHERE p >= 0.5 AND target > 0) AS tp, COUNT(*) FILTER (WHERE p >= 0.5) AS pp,
         COUNT(*) FILTER (WHERE target > 0) AS ap
  FROM errs
),
m2 AS (SELECT *, tp / GREATEST(pp, 1) AS prec, tp / GREATEST(ap, 1) AS rec FROM m)""", select=f"""
SELECT {r('mae')} AS mae, {r('rmse')} AS rmse, {r('base_mae')} AS base_mae, {r('base_rmse')} AS base_rmse,
       {r('(1.0 - CASE WHEN base_mae = 0 THEN NULL ELSE mae / base_mae END) * 100.0')} AS improvement_pct,
       {r('prec')} AS precision, {r('rec')} AS recall,
       {r('2.0 * prec * rec / GREATEST(prec + rec, 1e-12)')} AS f1
FROM m2""")


@register("forecast_metrics", _metrics_sql(False))
def q_forecast_metrics(spark, sf):
    return round_doubles(metrics.forecast_metrics(_preds(spark, sf)))


@register("forecast_metrics_flipped", _metrics_sql(True))
def q_forecast_metrics_flipped(spark, sf):
    return round_doubles(metrics.forecast_metrics(_preds(spark, sf, True)))


@register("demand_class_mae", with_ctes(*_errors_cte(True), select=f"""
SELECT CASE WHEN target > 0 THEN 'active demand' ELSE 'zero demand' END AS demand_class,
       {r('AVG(ABS(e_median))')} AS mae, {r('AVG(ABS(e_base))')} AS base_mae,
       {r('CASE WHEN AVG(ABS(e_base)) <> 0 THEN (1.0 - AVG(ABS(e_median)) / AVG(ABS(e_base))) * 100.0 END')} AS improvement_pct
FROM errs GROUP BY 1"""))
def q_demand_class_mae(spark, sf):
    return round_doubles(metrics.demand_class_mae(_preds(spark, sf, True)))


@register("hurdle_loss", with_ctes(*_pred_ctes(True), """l1 AS (
  SELECT *, LEAST(GREATEST(p, 1e-12), 1.0 - 1e-12) AS pp FROM preds),
l2 AS (SELECT *, LN(pp / (1.0 - pp)) AS logit, CASE WHEN target_log > 0 THEN 1.0 ELSE 0.0 END AS y FROM l1),
l3 AS (
  SELECT AVG(GREATEST(logit, 0.0) - logit * y + LN(1 + EXP(-ABS(logit)))) AS bce,
         COALESCE(AVG(CASE WHEN target_log > 0 THEN 0.5 * ((target_log - mu) / sigma) * ((target_log - mu) / sigma)
                           + LN(sigma) END), 0.0) AS count_nll,
         COALESCE(AVG(CASE WHEN target_log > 0 THEN ABS(GREATEST(EXP(mu) - 1, 0.0) - GREATEST(EXP(target_log) - 1, 0.0))
                      END), 0.0) AS request_mae
  FROM l2)""", select=f"""
SELECT {r('bce')} AS bce, {r('count_nll')} AS count_nll, {r('request_mae')} AS request_mae,
       {r('bce + count_nll + request_mae / 1000.0')} AS loss FROM l3"""))
def q_hurdle_loss(spark, sf):
    return round_doubles(metrics.hurdle_loss(_preds(spark, sf, True)))


@register("mse_loss", with_ctes(*_pred_ctes(False), select=
          f"SELECT {r('AVG((mu - target_log) * (mu - target_log))')} AS mse FROM preds"))
def q_mse_loss(spark, sf):
    return round_doubles(metrics.mse_loss(_preds(spark, sf)))


@register("pinball_loss", with_ctes(*_pred_ctes(False), select=
          f"SELECT {r('AVG(GREATEST(0.5 * (target_log - mu), (0.5 - 1.0) * (target_log - mu)))')} AS pinball FROM preds"))
def q_pinball_loss(spark, sf):
    return round_doubles(metrics.pinball_loss(_preds(spark, sf), 0.5))


@register("per_sample_scores", with_ctes(*_pred_ctes(True), """s1 AS (
  SELECT {K}, origin_minute, GREATEST(EXP(target_log) - 1, 0.0) AS t,
         p * GREATEST(EXP(mu + 0.5 * sigma * sigma) - 1, 0.0) - GREATEST(EXP(target_log) - 1, 0.0) AS e
  FROM preds),
s2 AS (SELECT *, AVG(t) OVER (PARTITION BY {K}, origin_minute) AS tm FROM s1),
s3 AS (SELECT {K}, origin_minute, AVG(ABS(e)) AS mae, SQRT(AVG(e * e)) AS rmse, SUM(e * e) AS sse,
              SUM((t - tm) * (t - tm)) AS sst FROM s2 GROUP BY ALL)""".replace("{K}", K), select=
          f"SELECT {K}, origin_minute, {r('mae')} AS mae, {r('rmse')} AS rmse, "
          f"{r('CASE WHEN sst > 0 THEN 1.0 - sse / sst END')} AS r2 FROM s3"))
def q_per_sample_scores(spark, sf):
    return round_doubles(metrics.per_sample_scores(_preds(spark, sf, True)))


@register("best_horizon_step", with_ctes(*_errors_cte(False), select=f"""
SELECT run, CAST(arg_min(step, (mae, step)) AS INTEGER) AS best_epoch, {r('MIN(mae)')} AS best_validation_mae
FROM (SELECT 'p' AS run, step, AVG(ABS(e_median)) AS mae FROM errs GROUP BY step
      UNION ALL
      SELECT 'persistence' AS run, step, AVG(ABS(e_base)) AS mae FROM errs GROUP BY step) GROUP BY run"""))
def q_best_horizon_step(spark, sf):
    """M11 over a metrics table derived from the predictions: per run, the horizon step with the
    least MAE (model selection by least validation metric)."""
    e = metrics.errors(_preds(spark, sf))
    log = (e.groupBy("step").agg(F.avg(F.abs("e_median")).alias("validation_mae")).withColumn("run", F.lit("p"))
           .unionByName(e.groupBy("step").agg(F.avg(F.abs("e_base")).alias("validation_mae"))
                        .withColumn("run", F.lit("persistence"))))
    return round_doubles(metrics.best_epoch(log.withColumnRenamed("step", "epoch")))


def _forecaster_rows(spark, sf):
    """(origin, step) rows of all windows, scaled with the statistics of training rows only."""
    from minutewise.operators import windows as win
    from minutewise.operators.forecaster import step_rows
    from minutewise.plans.q_windows import _features
    from minutewise.session import stored
    f = _features(spark, sf)
    return stored(step_rows(win.normalise(f, win.feature_statistics(f, fit_on="train"))), "steps", "split")


@register("hurdle_forecaster_metrics", None)
def q_hurdle_forecaster_metrics(spark, sf):
    """T1/T2 (rows-only: model fitting is not SQL): fit on the training windows, score the test
    windows, and report the forecast metrics against persistence."""
    from minutewise.operators.forecaster import fit_hurdle, score
    rows = _forecaster_rows(spark, sf)
    model = fit_hurdle(rows.where("split = 'train'"))
    return round_doubles(metrics.forecast_metrics(score(model, rows.where("split = 'test'"))))


def _forecaster_invariants_sql() -> str:
    from minutewise.plans.q_windows import FEAT_CTES, GROUPS_CTE, INDEX_CTE, SPLIT_CTE, WINDOWS_CTE
    return with_ctes(*FEAT_CTES, GROUPS_CTE, INDEX_CTE, WINDOWS_CTE, SPLIT_CTE, select=f"""
SELECT CAST(10 * COUNT(*) AS BIGINT) AS n_scored, CAST(0 AS BIGINT) AS n_bad_sigma, CAST(0 AS BIGINT) AS n_bad_p,
       CAST(0 AS BIGINT) AS n_bad_mu, CAST(COUNT(DISTINCT ({K})) AS BIGINT) AS n_groups, CAST(10 AS BIGINT) AS n_steps
FROM wsplit WHERE split = 'test'""")


@register("hurdle_forecaster_invariants", _forecaster_invariants_sql())
def q_hurdle_forecaster_invariants(spark, sf):
    """T1/T2 against SQL: ten predictions for each test window, within their bounds, for every group."""
    from minutewise.operators.forecaster import fit_hurdle, score
    rows = _forecaster_rows(spark, sf)
    out = score(fit_hurdle(rows.where("split = 'train'")), rows.where("split = 'test'"))
    bad = lambda c: F.count_if(F.coalesce(c, F.lit(True)))
    return out.agg(F.count(F.lit(1)).alias("n_scored"),
                   bad((F.col("sigma") < 0.05) | (F.col("sigma") > 1.0) | F.isnan("sigma")).alias("n_bad_sigma"),
                   bad((F.col("p") < 0) | (F.col("p") > 1) | F.isnan("p")).alias("n_bad_p"),
                   bad(F.isnan("mu") | (F.abs("mu") > 1e6)).alias("n_bad_mu"),
                   F.countDistinct(F.struct(*KEY)).alias("n_groups"), F.countDistinct("step").alias("n_steps"))
