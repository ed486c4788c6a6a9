"""Standard normal CDF and inverse CDF as Spark Column expressions.

Spark SQL has no erf/ndtri, so both are built from published rational approximations and
stay inside whole-stage codegen (no UDF):

* Φ: Hart's double-precision algorithm 5666 as given by G. West, "Better approximations to
  cumulative normal functions" (2005) — absolute error about 1e-15.
* Φ⁻¹: P. J. Acklam's rational approximation (relative error 1.15e-9) refined by one Halley
  step with the Φ above.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- Fixed values: published coefficients ------------------------------------------------
# Hart 5666 / West: numerator and denominator for |x| < 7.07106781186547, highest degree first.
HART_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
            112.079291497871, 221.213596169931, 220.206867912376]
HART_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
            296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
HART_SPLIT = 7.07106781186547
HART_TAIL_LIMIT = 37.0
SQRT_2PI = 2.506628274631
# Acklam: central region (a, b) and tails (c, d), highest degree first.
ACKLAM_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
ACKLAM_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01]
ACKLAM_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
ACKLAM_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00]
ACKLAM_P_LOW = 0.02425
# ------------------------------------------------------------------------------------------


def _horner(coeffs: list[float], x: Column) -> Column:
    acc = F.lit(coeffs[0])
    for c in coeffs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def norm_cdf(x: Column) -> Column:
    """Φ(x) for a DOUBLE column."""
    ax = F.abs(x)
    e = F.exp(-ax * ax / 2.0)
    central = e * _horner(HART_NUM, ax) / _horner(HART_DEN, ax)
    frac = ax + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        frac = ax + F.lit(k) / frac
    tail = e / frac / F.lit(SQRT_2PI)
    lower = F.when(ax > HART_TAIL_LIMIT, F.lit(0.0)).when(ax < HART_SPLIT, central).otherwise(tail)
    return F.when(x > 0, F.lit(1.0) - lower).otherwise(lower)


def _acklam(p: Column) -> Column:
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    lo = _horner(ACKLAM_C, q_lo) / (_horner(ACKLAM_D, q_lo) * q_lo + F.lit(1.0))
    hi = -_horner(ACKLAM_C, q_hi) / (_horner(ACKLAM_D, q_hi) * q_hi + F.lit(1.0))
    q = p - F.lit(0.5)
    r = q * q
    mid = _horner(ACKLAM_A, r) * q / (_horner(ACKLAM_B, r) * r + F.lit(1.0))
    return (F.when(p < ACKLAM_P_LOW, lo).when(p > 1 - ACKLAM_P_LOW, hi).otherwise(mid))


def _halley(x: Column, p: Column) -> Column:
    err = norm_cdf(x) - p
    u = err * F.lit(math.sqrt(2 * math.pi)) * F.exp(x * x / 2.0)
    return F.when((p > 0) & (p < 1), x - u / (F.lit(1.0) + x * u / 2.0))


def norm_ppf(p: Column) -> Column:
    """Φ⁻¹(p) for p in (0, 1); NULL outside.

    One expression tree: the refinement evaluates Φ at the first estimate, so the estimate is
    repeated inside the tree. Fine for a column reference as ``p`` in a single place; for many
    quantiles per row use ``with_norm_ppf``, which binds the estimate as a column first.
    """
    return _halley(_acklam(p), p)


def with_norm_ppf(df: DataFrame, p_col: str, out_col: str) -> DataFrame:
    """Add ``out_col`` = Φ⁻¹(``p_col``) as staged projections: the estimate, Φ at the estimate,
    the Halley correction, the result.

    Each stage references the previous ones by name. Catalyst does not collapse a projection
    whose non-trivial expressions are used more than once, so the tree never repeats the
    estimate. Each stage also stays small enough for the JVM to compile its generated method;
    one fused method for the whole formula exceeds the JIT's size limit and runs interpreted.
    """
    x0, c0, u = f"_{out_col}_x0", f"_{out_col}_c0", f"_{out_col}_u"
    p = F.col(p_col)
    staged = df.withColumn(x0, _acklam(p))
    staged = staged.withColumn(c0, norm_cdf(F.col(x0)))
    x = F.col(x0)
    staged = staged.withColumn(u, (F.col(c0) - p) * F.lit(math.sqrt(2 * math.pi)) * F.exp(x * x / 2.0))
    refined = x - F.col(u) / (F.lit(1.0) + x * F.col(u) / 2.0)
    return staged.withColumn(out_col, F.when((p > 0) & (p < 1), refined)).drop(x0, c0, u)
