"""Zero-inflated ("hurdle") lognormal forecast maths as Column expressions.

Occurrence probability p = P(Y > 0); given demand, log1p(Y) ~ Normal(mu, sigma).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutewise.functions.normal import norm_cdf, norm_ppf, with_norm_ppf
from minutewise.functions.numeric import clamp
from minutewise.operators.features import frame_quantile
from minutewise.schema import KEY, WARM_LOOKBACK

P_EPS = 1e-6
# Fixed value: z of the 10 % / 90 % normal quantiles used by the plain lognormal report.
Q90_Z = 1.281551565545


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hurdle_quantile(mu, sigma, p, q: float) -> Column:
    """Request-count quantile q of the hurdle distribution (0 inside the zero atom)."""
    mu, sigma, p = _c(mu), _c(sigma), _c(p)
    pc = clamp(p, P_EPS, 1 - P_EPS)
    cond = (F.lit(q) - (F.lit(1.0) - pc)) / pc
    z = norm_ppf(clamp(cond, P_EPS, 1 - P_EPS))
    value = F.greatest(F.lit(0.0), F.expm1(mu + sigma * z))
    return F.when(cond > 0, value).otherwise(F.lit(0.0))


def with_hurdle_quantiles(df: DataFrame, quantiles: dict[str, float], mu: str = "mu", sigma: str = "sigma",
                          p: str = "p") -> DataFrame:
    """P1 for several quantiles at once as staged projections (see ``with_norm_ppf``).

    Adds one column per entry of ``quantiles`` (name → q). The other columns travel packed in
    one struct through the stages, which keeps every generated stage small and compiled.
    """
    rest = [c for c in df.columns if c not in (mu, sigma, p)]
    staged = df.select(F.struct(*rest).alias("_rest"), F.col(mu).alias("_mu"), F.col(sigma).alias("_sigma"),
                       F.col(p).alias("_p"))
    staged = staged.withColumn("_pc", clamp(F.col("_p"), P_EPS, 1 - P_EPS))
    for name, q in quantiles.items():
        staged = staged.withColumn(f"_c_{name}", (F.lit(q) - (F.lit(1.0) - F.col("_pc"))) / F.col("_pc"))
        staged = staged.withColumn(f"_k_{name}", clamp(F.col(f"_c_{name}"), P_EPS, 1 - P_EPS))
        staged = with_norm_ppf(staged, f"_k_{name}", f"_z_{name}")
    values = {
        name: F.when(F.col(f"_c_{name}") > 0,
                     F.greatest(F.lit(0.0), F.expm1(F.col("_mu") + F.col("_sigma") * F.col(f"_z_{name}"))))
        .otherwise(F.lit(0.0))
        for name in quantiles}
    out = staged.select(*[F.col(f"_rest.{c}").alias(c) for c in rest], F.col("_mu").alias(mu),
                        F.col("_sigma").alias(sigma), F.col("_p").alias(p),
                        *[v.alias(k) for k, v in values.items()])
    return out.select(*df.columns, *quantiles)


def hurdle_mean(mu, sigma, p, clamped: bool = True) -> Column:
    """p·max(0, exp(mu + σ²/2) − 1) (``clamped``) or p·(exp(mu + σ²/2) − 1)."""
    mu, sigma, p = _c(mu), _c(sigma), _c(p)
    cond = F.expm1(mu + F.lit(0.5) * sigma * sigma)
    return p * (F.greatest(cond, F.lit(0.0)) if clamped else cond)


def hurdle_std(mu, sigma, p) -> Column:
    """sqrt(max(p·E[Y²] − mean², 1e-12)) with the unclamped mean."""
    mu, sigma, p = _c(mu), _c(sigma), _c(p)
    second = F.exp(2.0 * mu + 2.0 * sigma * sigma) - 2.0 * F.exp(mu + 0.5 * sigma * sigma) + 1.0
    mean = hurdle_mean(mu, sigma, p, clamped=False)
    return F.sqrt(F.greatest(p * second - mean * mean, F.lit(1e-12)))


def lognormal_moments(mu, sigma) -> tuple[Column, Column]:
    """mean = exp(mu + σ²/2) − 1, std = sqrt(max((e^{σ²} − 1)·e^{2mu+σ²}, 1e-12))."""
    mu, sigma = _c(mu), _c(sigma)
    var = (F.exp(sigma * sigma) - 1.0) * F.exp(2.0 * mu + sigma * sigma)
    return F.exp(mu + 0.5 * sigma * sigma) - 1.0, F.sqrt(F.greatest(var, F.lit(1e-12)))


def lognormal_quantile(mu, sigma, z: float) -> Column:
    """max(0, expm1(mu + z·σ))."""
    return F.greatest(F.lit(0.0), F.expm1(_c(mu) + F.lit(z) * _c(sigma)))


def history_capacity(requests: str = "requests", lookback: int = WARM_LOOKBACK, order: str = "minute") -> Column:
    """P5: 90th percentile (linear) of the positive values among the last ``lookback`` rows; 0 if none."""
    w = Window.partitionBy(*KEY).orderBy(order).rowsBetween(-(lookback - 1), 0)
    r = F.col(requests)
    positive = F.sort_array(F.collect_list(F.when(r > 0, r.cast("double"))).over(w))
    # bound in an array of one, so that the frame is sorted once
    return F.coalesce(F.transform(F.array(positive), lambda x: frame_quantile(0.9, x, F.size(x)))[0], F.lit(0.0))


def cold_start_risk(mu, sigma, p, capacity) -> Column:
    """p·(1 − Φ((log1p(capacity) − mu) / max(sigma, 1e-6)))."""
    mu, sigma, p, cap = _c(mu), _c(sigma), _c(p), _c(capacity)
    z = (F.log1p(cap) - mu) / F.greatest(sigma, F.lit(1e-6))
    return p * (F.lit(1.0) - norm_cdf(z))


def forecast_record(predictions: DataFrame) -> DataFrame:
    """Mean, std, q10/q50/q90, cold-start risk and warm capacity for every prediction row."""
    mu, sigma, p = F.col("mu"), F.col("sigma"), F.col("p")
    q = with_hurdle_quantiles(predictions, {"q10": 0.10, "q50": 0.50, "q90": 0.90})
    return q.select(
        *KEY, "origin_minute", "step",
        hurdle_mean(mu, sigma, p, clamped=False).alias("mean"),
        hurdle_std(mu, sigma, p).alias("std"),
        "q10", "q50", "q90",
        cold_start_risk(mu, sigma, p, F.col("warm_capacity")).alias("cold_start_risk"),
        F.col("warm_capacity"),
    )


def lognormal_record(predictions: DataFrame) -> DataFrame:
    """P4 report (p = 1): mean, std and q10/q50/q90 of the plain lognormal."""
    mean, std = lognormal_moments("mu", "sigma")
    return predictions.select(*KEY, "origin_minute", "step", mean.alias("mean"), std.alias("std"),
                              lognormal_quantile("mu", "sigma", -Q90_Z).alias("q10"),
                              lognormal_quantile("mu", "sigma", 0.0).alias("q50"),
                              lognormal_quantile("mu", "sigma", Q90_Z).alias("q90"))


def persistence(predictions: DataFrame) -> DataFrame:
    """Last observed value repeated over the horizon, in request space."""
    return predictions.select(*KEY, "origin_minute", "step", F.expm1("last_log").alias("forecast"))
