"""Order statistics and exact samples of a distributed table, found by counting instead of sorting.

``percentile`` gathers all distinct values in one task, and a top-m gathers m whole rows of every task in one. Here
the driver narrows an interval down by histograms: each pass counts the rows of the interval by bin (partial counts in
the map tasks, a few thousand rows to the driver) and goes on with the bin that holds the wanted rank. Once an
interval holds at most ``FEW`` rows, its values are read. Passes read one narrow column; nothing is sorted, and no
task or driver holds more than ``FEW`` values for each wanted rank.

Callers pass a table that is cheap to read again (stored, or a checkpoint).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a pass, and rows of an interval from which its values are simply read.
BINS, FEW = 4096, 20_000


def order_statistics(df: DataFrame, value: Column | str, ranks: list[int], bins: int = BINS, few: int = FEW) -> list[float]:
    """The values of the given 0-based ranks in ascending order; NULLs are left out.

    Values must be finite. A pass splits the interval between the smallest and the largest value left into equal bins,
    and keeps the true bounds of the bin that holds the rank, so an interval of equal values ends the search.
    """
    vals = _values(df, value)
    return _statistics(vals, _bounds(vals), ranks, bins, few)


def _values(df: DataFrame, value: Column | str) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return df.select(v.cast("double").alias("v")).where(F.col("v").isNotNull())


def _bounds(vals: DataFrame) -> tuple[float, float, int]:
    r = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    return r["lo"], r["hi"], r["n"]


def _statistics(vals: DataFrame, whole: tuple[float, float, int], ranks: list[int], bins: int, few: int) -> list[float]:
    if any(not 0 <= r < whole[2] for r in ranks):
        raise ValueError(f"{whole[2]} values have no ranks {ranks}")
    if ranks and not (math.isfinite(whole[0]) and math.isfinite(whole[1])):
        raise ValueError(f"values from {whole[0]} to {whole[1]} have no histogram")
    found: dict[int, float] = {}
    open_ = [(*whole, {r: r for r in ranks})]  # interval, rows in it, rank -> rank inside
    while open_:
        lo, hi, n, wanted = open_.pop()
        if lo == hi:
            found.update(dict.fromkeys(wanted, lo))
            continue
        inside = vals.where(F.col("v").between(lo, hi))
        if n <= few or hi / 2 == lo / 2:
            counts = sorted((r["v"], r["n"]) for r in inside.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect())
            bounds = [(x, x, c) for x, c in counts]
        else:
            # halves before the difference, which could overflow
            share = (F.col("v") / 2 - lo / 2) / (hi / 2 - lo / 2)
            bin_ = F.least(F.floor(share * bins), F.lit(bins - 1))
            rows = inside.groupBy(bin_.alias("b")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
            bounds = sorted((r["lo"], r["hi"], r["n"]) for r in rows.collect())
        below = 0
        for a, b, c in bounds:
            here = {r: k - below for r, k in wanted.items() if below <= k < below + c}
            if here:
                open_.append((a, b, c, here))
            below += c
    return [found[r] for r in ranks]


def exact_quantiles(df: DataFrame, value: Column | str, qs: list[float], bins: int = BINS, few: int = FEW) -> list[float | None]:
    """Quantiles with linear interpolation between the two nearest ranks, as ``percentile`` gives; NULL without values."""
    vals = _values(df, value)
    whole = _bounds(vals)
    n = whole[2]
    if n == 0:
        return [None] * len(qs)
    at = [(n - 1) * q for q in qs]
    ranks = sorted({f(x) for x in at for f in (math.floor, math.ceil)})
    values = dict(zip(ranks, _statistics(vals, whole, ranks, bins, few)))
    out = []
    for x in at:
        a, b = values[math.floor(x)], values[math.ceil(x)]
        out.append(a if a == b else (math.ceil(x) - x) * a + (x - math.floor(x)) * b)
    return out


def quantile_array(df: DataFrame, value: Column | str, qs: list[float]) -> Column:
    """``exact_quantiles`` as an array literal for use in expressions."""
    return F.array(*[F.lit(q).cast("double") for q in exact_quantiles(df, value, qs)])


def first_by_text_order(df: DataFrame, m: int, text: Column, key: Column, few: int = FEW) -> DataFrame:
    """The ``m`` rows that come first by (``text``, ``key``), where ``text`` is made of hexadecimal digits (a digest).

    Counts by a growing prefix of the digest find the row at rank m; the result is a plain filter on it. Rows equal in
    both columns to the m-th are all kept, so (``text``, ``key``) should be a key of the table.
    """
    if m <= 0:
        return df.limit(0)
    keyed = df.select(text.alias("t"), key.alias("k"))
    prefix, left, n = "", m, None
    while n is None or n > few:
        digits = len(prefix) + 3
        if n is not None and len(prefix) >= 32:  # whole digests are equal
            break
        rows = keyed if not prefix else keyed.where(F.col("t").startswith(prefix))
        counts = sorted((r["p"], r["n"]) for r in rows.groupBy(F.substring("t", 1, digits).alias("p"))
                        .agg(F.count(F.lit(1)).alias("n")).collect())
        if left > sum(c for _, c in counts):  # fewer rows than asked for
            return df
        for p, c in counts:
            if left <= c:
                prefix, n = p, c
                break
            left -= c
    near = sorted((r["t"], r["k"]) for r in keyed.where(F.col("t").startswith(prefix)).collect())
    t, k = near[left - 1]
    return df.where((text < F.lit(t)) | ((text == F.lit(t)) & (key <= F.lit(k))))
