import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from minutewise.functions.normal import norm_cdf, norm_ppf, with_norm_ppf
from minutewise.operators import hurdle, metrics

ND = NormalDist()


def test_norm_cdf_and_ppf(spark):
    xs = [x / 10 for x in range(-80, 81)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", norm_cdf(F.col("x")).alias("c")).collect()
    assert max(abs(r.c - ND.cdf(r.x)) for r in got) < 1e-14
    ps = [1e-6, 1e-4, 0.02, 0.02425, 0.1, 0.5, 0.77, 0.97575, 0.999, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    a = df.select("p", norm_ppf(F.col("p")).alias("z")).collect()
    b = with_norm_ppf(df, "p", "z").collect()
    for rows in (a, b):
        assert max(abs(r.z - ND.inv_cdf(r.p)) for r in rows) < 1e-9


def _py_quantile(mu, s, p, q):
    p = min(max(p, 1e-6), 1 - 1e-6)
    c = (q - (1 - p)) / p
    if c <= 0:
        return 0.0
    c = min(max(c, 1e-6), 1 - 1e-6)
    return max(0.0, math.expm1(mu + s * ND.inv_cdf(c)))


@pytest.mark.parametrize("p", [0.0, 1e-6, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("sigma", [0.05, 1.0])
def test_hurdle_quantities(spark, p, sigma):
    mu, cap = 1.3, 4.0
    df = spark.createDataFrame([(mu, sigma, p, cap)], "mu double, sigma double, p double, cap double")
    q = hurdle.with_hurdle_quantiles(df, {"q10": 0.1, "q50": 0.5, "q90": 0.9})
    r = q.select("*", hurdle.hurdle_mean("mu", "sigma", "p").alias("mean"),
                 hurdle.hurdle_mean("mu", "sigma", "p", clamped=False).alias("mean_u"),
                 hurdle.hurdle_std("mu", "sigma", "p").alias("std"),
                 hurdle.cold_start_risk("mu", "sigma", "p", "cap").alias("risk")).first()
    for name, qq in (("q10", 0.1), ("q50", 0.5), ("q90", 0.9)):
        assert abs(getattr(r, name) - _py_quantile(mu, sigma, p, qq)) < 1e-6 * max(1, getattr(r, name))
    assert r.q10 <= r.q50 <= r.q90
    m = p * max(0.0, math.exp(mu + sigma ** 2 / 2) - 1)
    assert abs(r.mean - m) < 1e-9 * max(1, m)
    second = math.exp(2 * mu + 2 * sigma ** 2) - 2 * math.exp(mu + sigma ** 2 / 2) + 1
    mu_ = p * (math.exp(mu + sigma ** 2 / 2) - 1)
    assert abs(r.std - math.sqrt(max(p * second - mu_ ** 2, 1e-12))) < 1e-9 * max(1, r.std)
    risk = p * (1 - ND.cdf((math.log1p(cap) - mu) / max(sigma, 1e-6)))
    assert abs(r.risk - risk) < 1e-12 and 0 <= r.risk <= 1


def test_history_capacity(spark):
    from pyspark.sql import Window
    rows = [("R", "c", "f", m, v) for m, v in enumerate([0, 0, 0])] + \
           [("R", "c", "g", m, v) for m, v in enumerate([0, 7, 0])]
    df = spark.createDataFrame(rows, "region string, clusterName string, funcName string, minute int, requests long")
    got = {(r.funcName, r.minute): r.cap for r in df.select("*", hurdle.history_capacity().alias("cap")).collect()}
    assert got[("f", 2)] == 0.0 and got[("g", 0)] == 0.0 and got[("g", 2)] == 7.0


def _preds(spark, rows):
    return spark.createDataFrame(
        [("R", "c", "f", i, 1, *r) for i, r in enumerate(rows)],
        "region string, clusterName string, funcName string, origin_minute int, step int, "
        "mu double, sigma double, p double, target_log double, last_log double")


def test_metrics_edge_cases(spark):
    # no active target, persistence exact (base MAE 0) → improvement NULL, precision/recall 0
    p = _preds(spark, [(0.0, 0.5, 0.1, 0.0, 0.0), (0.0, 0.5, 0.2, 0.0, 0.0)])
    m = metrics.forecast_metrics(p).first()
    assert m.base_mae == 0.0 and m.improvement_pct is None
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1 == 0.0
    classes = {r.demand_class for r in metrics.demand_class_mae(p).collect()}
    assert classes == {"zero demand"}
    loss = metrics.hurdle_loss(p).first()
    assert loss.count_nll == 0.0 and loss.request_mae == 0.0
    assert abs(loss.bce - (-math.log(0.9) - math.log(0.8)) / 2) < 1e-12


def test_pinball_and_best_epoch(spark):
    p = _preds(spark, [(1.0, 0.5, 0.9, 2.0, 0.0), (1.0, 0.5, 0.9, 0.0, 0.0)])
    assert abs(metrics.pinball_loss(p, 0.5).first().pinball - 0.5) < 1e-12
    assert abs(metrics.mse_loss(p).first().mse - 1.0) < 1e-12
    log = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 1.0), ("a", 3, 1.0), ("b", 1, 2.0)],
                                "run string, epoch int, validation_mae double")
    got = {r.run: (r.best_epoch, r.best_validation_mae) for r in metrics.best_epoch(log).collect()}
    assert got == {"a": (2, 1.0), "b": (1, 2.0)}


def test_hurdle_forecaster_bounds_and_determinism(spark):
    from minutewise.operators.forecaster import fit_hurdle, score
    from minutewise.plans.q_forecast import _forecaster_rows
    rows = _forecaster_rows(spark, "/root/testdata/sf0.001")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    m1, m2 = fit_hurdle(train), fit_hurdle(train)
    assert list(m1.residual.coefficients) == list(m2.residual.coefficients)
    pred = score(m1, test)
    agg = pred.agg(F.min("sigma"), F.max("sigma"), F.min("p"), F.max("p"), F.count("*")).first()
    assert 0.05 <= agg[0] <= agg[1] <= 1.0 and 0.0 <= agg[2] <= agg[3] <= 1.0
    assert agg[4] == test.count()


def test_hurdle_forecaster_recovers_known_coefficients(spark):
    """T1 on generated data: occurrence and residual follow known linear rules."""
    import math
    import random

    import pytest

    from minutewise.operators.forecaster import fit_hurdle
    rng = random.Random(1)
    rows = []
    for i in range(6000):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        on = rng.random() < 1 / (1 + math.exp(-(0.5 + 1.5 * x)))
        last = rng.random()
        target = max(0.01, last + 2.0 + 0.3 * x - 0.2 * z + rng.gauss(0, 0.1)) if on else 0.0
        rows.append(("R", "c", "f", i, 1 + i % 10, x, z, last, target, 0.0, 0.0, 0.0, 0.0))
    df = spark.createDataFrame(rows, "region string, clusterName string, funcName string, origin_minute int, step int, x1 double, "
                                     "x2 double, last_log double, target_log double, f_hour_sin double, f_hour_cos double, "
                                     "f_minute_sin double, f_minute_cos double")
    m = fit_hurdle(df, ["x1", "x2"])
    occ, res = m.occurrence.coefficients.toArray(), m.residual.coefficients.toArray()
    assert abs(occ[0] - 1.5) < 0.15 and abs(occ[1]) < 0.1 and abs(m.occurrence.intercept - 0.5) < 0.3
    assert abs(res[0] - 0.3) < 0.02 and abs(res[1] + 0.2) < 0.02 and abs(m.residual.intercept - 2.0) < 0.05
    assert abs(m.pooled_sigma - 0.1) < 0.01
    with pytest.raises(RuntimeError):
        fit_hurdle(df, ["x1", "x2"], limit=1)
