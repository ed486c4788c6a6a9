"""Lag, rolling, ratio and cyclic features over per-group minute series.

All window expressions share one specification (partition by group, order by minute), so
Catalyst evaluates them in a single Window operator after a single exchange + sort; when the
input is the dense calendar (already partitioned by group) there is no exchange at all.
Rolling frames are row frames ending at the current row, as in the reference feature table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutewise.schema import KEY
from minutewise.session import materialize

LAGS = (1, 5, 15, 30)
MEANS = (5, 15, 30)
ROLL = 30


def series_window(order: str = "minute"):
    return Window.partitionBy(*KEY).orderBy(order)


def _frame(n: int):
    return series_window().rowsBetween(-(n - 1), Window.currentRow)


def safe_ratio(num: Column, den: Column, zero_div: str = "null") -> Column:
    """num/den; at den = 0 gives NULL (``zero_div='null'``) or 0.0 (``'zero'``)."""
    if zero_div == "zero":
        return F.coalesce(F.try_divide(num, den), F.lit(0.0))
    return num / F.nullif(den, F.lit(0))


def nonzero_values(value: Column, frame) -> list[Column]:
    """What ``frame_quantile`` needs of a row frame of values ≥ 0: the values above 0, and how many values there are.

    Series of demand are mostly zeros, which need no sorting; ``percentile`` builds and sorts a map for every row.
    """
    return [F.collect_list(F.when(value > 0, value)).over(frame).alias("_above"), F.count(value).over(frame).alias("_n")]


def frame_quantile(q: float, above: Column | str = "_sorted", n: Column | str = "_n") -> Column:
    """The q-quantile (linear interpolation, as ``percentile``) of ``n`` values ≥ 0, of which ``above`` holds those
    above 0 in ascending order; NULL of none."""
    above, n = (F.col(c) if isinstance(c, str) else c for c in (above, n))
    zeros = n - F.size(above)

    def at(i: Column) -> Column:
        return F.when(i < zeros, F.lit(0.0)).otherwise(F.get(above, (i - zeros).cast("int")).cast("double"))

    place = (n - 1) * F.lit(q)
    low, high = F.floor(place), F.ceil(place)
    between = (high - place) * at(low) + (place - low) * at(high)
    return F.when(n == 0, None).when((low == high) | (at(low) == at(high)), at(low)).otherwise(between)


def rolling_features(df: DataFrame, value: str = "requests", std: str = "samp") -> DataFrame:
    """Lags, rolling mean 5/15/30, std/max/min/median/q90 over 30 rows.

    ``std='pop'`` gives the population deviation of the raw-trace variant (G8).
    """
    v = F.col(value)
    w = series_window()
    w30 = _frame(ROLL)
    std_fn = F.stddev_samp if std == "samp" else F.stddev_pop
    cols = [F.lag(v, k).over(w).alias(f"lag_{k}") for k in LAGS]
    cols += [F.avg(v).over(_frame(n)).alias(f"rolling_mean_{n}") for n in MEANS]
    cols += [
        std_fn(v).over(w30).alias("rolling_std"),
        F.max(v).over(w30).alias("rolling_max"),
        F.min(v).over(w30).alias("rolling_min"),
        *nonzero_values(v, w30),
    ]
    out = df.select("*", *cols).withColumn("_sorted", F.sort_array("_above"))
    return (out.withColumns({"rolling_median": frame_quantile(0.5), "warm_capacity": frame_quantile(0.9)})
            .drop("_above", "_n", "_sorted"))


def trend(value: str = "requests", prev: str = "lag_1") -> Column:
    """value − coalesce(prev, value) (0 on the first row)."""
    return F.col(value) - F.coalesce(F.col(prev), F.col(value))


def growth_rate(value: str = "requests", prev: str = "lag_1", mode: str = "sql") -> Column:
    """F19 (``sql``): 0 when coalesce(prev, 0) = 0 else (v − prev)/prev.

    G9 (``pct_change``): same value with ±inf and NULL mapped to 0 — identical for counts ≥ 0.
    """
    v, p = F.col(value), F.col(prev)
    if mode == "pct_change":
        return F.coalesce(F.try_divide(v - p, p), F.lit(0.0))
    return F.when(F.coalesce(p, F.lit(0)) == 0, F.lit(0.0)).otherwise((v - p) / p)


def coeff_variation(std: str = "rolling_std", mean: str = "rolling_mean_30", zero_div: str = "null") -> Column:
    """0 when mean = 0 else std/mean (NULL while std is NULL); G10 maps NULL to 0."""
    if zero_div == "zero":
        return F.coalesce(F.try_divide(F.col(std), F.col(mean)), F.lit(0.0))
    return F.when(F.col(mean) == 0, F.lit(0.0)).otherwise(F.col(std) / F.col(mean))


def warm_ratio(value: str = "requests", capacity: str = "warm_capacity") -> Column:
    """0 when capacity = 0 else value/capacity."""
    return F.when(F.col(capacity) == 0, F.lit(0.0)).otherwise(F.col(value) / F.col(capacity))


def time_features(minute: str = "minute") -> list[Column]:
    """minute_of_hour, hour_of_day and their sin/cos encodings."""
    m = F.col(minute)
    moh = (m % 60).cast("int")
    hod = (F.floor(m / F.lit(60.0)) % 24).cast("int")
    two_pi = F.lit(2 * math.pi)
    return [
        moh.alias("minute_of_hour"),
        hod.alias("hour_of_day"),
        F.sin(two_pi * hod / F.lit(24.0)).alias("hour_sin"),
        F.cos(two_pi * hod / F.lit(24.0)).alias("hour_cos"),
        F.sin(two_pi * moh / F.lit(60.0)).alias("minute_sin"),
        F.cos(two_pi * moh / F.lit(60.0)).alias("minute_cos"),
    ]


def derived_features(zero_div: str = "null", growth: str = "sql") -> list[Column]:
    """F18–F22 as column expressions (``zero_div='zero'`` is the raw-trace rule G10)."""
    per_request = [safe_ratio(F.col(f"avg_{x}"), F.col("requests"), zero_div).alias(f"{x}_per_request")
                   for x in ("cpu", "memory", "runtime")]
    wr = warm_ratio() if zero_div == "null" else safe_ratio(F.col("requests"), F.col("warm_capacity"), "zero")
    return [
        trend().alias("trend"),
        growth_rate(mode=growth).alias("growth_rate"),
        coeff_variation(zero_div=zero_div).alias("coeff_variation"),
        *per_request,
        wr.alias("warm_ratio"),
    ]


def group_metadata_columns(total_quantiles: Column | None = None) -> list[Column]:
    """Metadata columns of F17 computed as whole-group window aggregates (no join).

    Same values as joining ``function_metadata``: total, category (F7) and stability (F8).
    ``total_quantiles`` is the array [q80, q25] of group totals.
    """
    g = Window.partitionBy(*KEY)
    total = F.sum("requests").over(g).cast("long")
    mean = F.avg("requests").over(g)
    std = F.stddev_samp("requests").over(g)
    cols = [total.alias("total_requests")]
    if total_quantiles is not None:
        cols.append(F.when(total >= total_quantiles[0], "Hot").when(total <= total_quantiles[1], "Rare")
                    .otherwise("Normal").alias("category"))
    stab = F.when(mean == 0, "Noisy").when(std / mean > 1, "Noisy").otherwise("Stable")
    cols.append(stab.alias("stability"))
    return cols


def feature_table(dense: DataFrame, metadata: DataFrame | None = None,
                  group_totals: DataFrame | None = None) -> DataFrame:
    """dense columns + F10–F16 + metadata (category, stability, total_requests) + F18–F24.

    Default: the metadata columns are whole-group window aggregates over the same group
    partitioning as the rolling windows, so the dense table is exchanged at most once (not at
    all when it comes from the group-partitioned calendar or a checkpoint of it) and no join is
    planned. The group-total quantiles for the category are literals, found first.
    ``group_totals`` (K, total_requests) may be given to find them from a smaller
    table — the sparse minute table has the same totals, zero minutes add nothing.
    An explicit ``metadata`` table (e.g. fitted on the training minutes only) is left-joined
    null-safely on the group key instead.
    """
    base = rolling_features(dense)
    if metadata is None:
        from minutewise.operators.metadata import group_statistics, total_quantiles
        totals = materialize(group_totals if group_totals is not None else group_statistics(dense))
        q = total_quantiles(totals)
        base = base.select("*", *group_metadata_columns(q))
    else:
        meta = metadata.select(*KEY, "category", "stability", "total_requests")
        base = base.join(meta, on=[base[k].eqNullSafe(meta[k]) for k in KEY], how="left").drop(
            *[meta[k] for k in KEY])
    return base.select("*", *derived_features(), *time_features())


# ---- sparse (active-minute) rolling table ------------------------------------------------

def sparse_rolling_features(sparse: DataFrame) -> DataFrame:
    """R1–R6 over observed minutes only: the previous row is the previous *active* minute."""
    v = F.col("requests")
    w = series_window()
    out = sparse.select(
        "*",
        F.lag(v, 1).over(w).alias("prev_requests"),
        *[F.avg(v).over(_frame(n)).alias(f"rolling_mean_{n}") for n in MEANS],
        F.stddev_samp(v).over(_frame(15)).alias("rolling_std_15"),
        F.stddev_samp(v).over(_frame(30)).alias("rolling_std_30"),
        F.avg(v).over(_frame(10)).alias("ema_10"),
        *nonzero_values(v, _frame(30)),
    )
    out = out.withColumn("_sorted", F.sort_array("_above")).withColumn("warm_capacity", frame_quantile(0.9))
    return out.drop("_above", "_n", "_sorted").select("*", trend(prev="prev_requests").alias("trend"),
                      growth_rate(prev="prev_requests").alias("growth_rate"))


# ---- raw-trace variant options -----------------------------------------------------------

def drop_short_groups(df: DataFrame, min_rows: int = 70) -> DataFrame:
    """Keep groups with at least ``min_rows`` rows (count over the group, no join)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*KEY))
    return df.withColumn("_n", n).where(F.col("_n") >= min_rows).drop("_n")


def raw_variant_features(dense: DataFrame) -> DataFrame:
    """Population std, pct-change growth, 0 at every zero denominator."""
    base = rolling_features(dense, std="pop")
    return base.select("*", *derived_features(zero_div="zero", growth="pct_change"), *time_features())
