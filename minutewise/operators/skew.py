"""Workload skew and classification by funcName: categories, reuse, Lorenz/Gini, top shares,
stability by median CV, rank–size series and histograms.

Inputs are per-function tables (one row per function). Lorenz, Gini and top shares come from a stored table of
values and how many functions have each, so functions are counted, never sorted; ranks by name use the distributed
exact rank of ``ordering``, quantiles the counting passes of ``selection``; histogram bounds are one-row
scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutewise.operators.ordering import global_rank, running_totals
from minutewise.operators.selection import quantile_array
from minutewise.session import stored

#: Points of a Lorenz curve that one row is expanded to at a time, and rows of an output task.
LORENZ_BLOCK, LORENZ_TASK = 1 << 16, 2_000_000


def invocation_category(functions: DataFrame, rare_q: float = 0.20, hot_q: float = 0.80) -> DataFrame:
    """A10: Rare when invocations ≤ q20 (tested first), Hot when ≥ q80, else Normal.

    ``functions`` is read several times for the quantiles: pass a stored table."""
    q = quantile_array(functions, "invocations", [rare_q, hot_q])
    inv = F.col("invocations")
    cat = F.when(inv <= q[0], "Rare").when(inv >= q[1], "Hot").otherwise("Normal")
    return functions.withColumn("category", cat)


def category_counts(classified: DataFrame) -> DataFrame:
    """A11."""
    return classified.groupBy("category").agg(F.count(F.lit(1)).alias("n_functions"))


def category_share(classified: DataFrame) -> DataFrame:
    """Share of functions per category in percent, from one aggregate (its three rows are summed by a window)."""
    counts = classified.groupBy("category").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(F.lit(0)))
    return counts.select("category", (F.col("_n") / total * 100.0).alias("pct"))


def reuse_ratios(functions: DataFrame) -> DataFrame:
    """A12 (per function): requests per distinct pod and per distinct user."""
    return functions.select(
        "funcName", "invocations",
        F.try_divide(F.col("invocations"), F.col("pods")).alias("requests_per_pod"),
        F.try_divide(F.col("invocations"), F.col("users")).alias("requests_per_user"))


def reuse_summary(ratios: DataFrame) -> DataFrame:
    """A12 (aggregates): mean and max of both ratios over functions."""
    return ratios.agg(F.avg("requests_per_pod").alias("mean_requests_per_pod"),
                      F.max("requests_per_pod").alias("max_requests_per_pod"),
                      F.avg("requests_per_user").alias("mean_requests_per_user"),
                      F.max("requests_per_user").alias("max_requests_per_user"))


def value_frequencies(functions: DataFrame, value: str = "invocations") -> DataFrame:
    """value, n (functions that have it), total (value * n) and the running sums n_upto and total_upto over ascending
    values, this one included. A NULL value counts as 0.

    The counts are stored once, and ``functions`` is read once for them. They have one row per distinct value: with R
    requests at most about sqrt(2 R) rows, however many functions there are."""
    counts = functions.groupBy(F.coalesce(F.col(value), F.lit(0)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "value-frequencies").withColumn("total", F.col("value") * F.col("n"))
    return running_totals(counts, [F.col("value")], {"n_upto": "n", "total_upto": "total"})


def lorenz_curve(functions: DataFrame, value: str = "invocations") -> DataFrame:
    """(x, lorenz) with a leading (0, 0); x = i/n over ascending values. No functions: the leading point alone; all
    values 0: NULL shares.

    Running shares of sorted values do not depend on how ties are ordered, so the points of a value follow from its
    row of ``value_frequencies``. A value is expanded in blocks, dealt over as many tasks as the points need, so a value
    that a third of the functions share is not one task's."""
    origin = functions.sparkSession.range(1).select(F.lit(0.0).alias("x"), F.lit(0.0).alias("lorenz"))
    freq = value_frequencies(functions, value)
    n, t = freq.agg(F.sum("n"), F.sum("total")).first()
    if not n:
        return origin
    # the number of tasks is given, as adaptive execution would go by the few bytes that come in
    blocks = (freq.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {LORENZ_BLOCK}"))))
              .repartition(-(-n // LORENZ_TASK), "value", "_block"))
    first = F.col("_block") * LORENZ_BLOCK
    j = F.explode(F.sequence(first + 1, F.least(F.col("n"), first + LORENZ_BLOCK)))
    pts = blocks.withColumn("_j", j).select(
        ((F.col("n_upto") - F.col("n") + F.col("_j")) / F.lit(n)).alias("x"),
        F.try_divide(F.col("total_upto") - F.col("total") + F.col("_j") * F.col("value"), F.lit(t)).alias("lorenz"))
    return origin.unionByName(pts)


def workload_skew(functions: DataFrame, shares=(0.01, 0.05, 0.10), value: str = "invocations") -> DataFrame:
    """A14 + A15 from one table of value frequencies and one aggregate of it.

    Gini is 1 − 2·trapezoid(Lorenz) in closed form, 2Σ i·x_i /(nΣx) − (n+1)/n (x ascending); the ranks i of a value's
    functions are consecutive. The top k = int(max(1, n·p)) functions of a share p take the last k ranks."""
    freq = value_frequencies(functions, value)
    total_n = freq.select(F.sum("n")).scalar()
    x, c, upto = F.col("value").cast("double"), F.col("n"), F.col("n_upto")
    ranks = c.cast("double") * (upto - c) + c.cast("double") * (c + 1) / 2
    cols = [F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum(x * ranks).alias("s")]
    for p in shares:
        k = F.greatest(F.lit(1.0), total_n * F.lit(p)).cast("long")
        taken = F.greatest(F.lit(0), F.least(c, upto - (total_n - k)))
        cols.append(F.sum(F.col("value") * taken).alias(f"_top_{round(p * 100)}"))
    agg = freq.agg(*cols)
    nn, t, s_ = F.col("n").cast("double"), F.col("t").cast("double"), F.col("s").cast("double")
    return agg.select((F.lit(2.0) * s_ / (nn * t) - (nn + 1) / nn).alias("gini"),
                      *[(F.col(f"_top_{round(p * 100)}") / F.col("t") * 100.0).alias(f"top_{round(p * 100)}_pct")
                        for p in shares])


def gini(functions: DataFrame, value: str = "invocations") -> DataFrame:
    """A14."""
    return workload_skew(functions, (), value)


def top_share(functions: DataFrame, shares=(0.01, 0.05, 0.10), value: str = "invocations") -> DataFrame:
    """Percent of all requests in the top p of functions."""
    return workload_skew(functions, shares, value).drop("gini")


def stability_by_median(variation: DataFrame) -> DataFrame:
    """Stable when cv ≤ median(cv) (NULLs skipped), else Noisy (a NULL cv is Noisy).

    ``variation`` is read several times for the median: pass a stored table."""
    m = quantile_array(variation, "cv", [0.5])[0]
    return variation.withColumn("stability", F.when(F.col("cv") <= m, "Stable").otherwise("Noisy"))


def stability_counts(classified: DataFrame) -> DataFrame:
    """A20."""
    return classified.groupBy("stability").agg(F.count(F.lit(1)).alias("n_functions"))


def rank_size(functions: DataFrame) -> DataFrame:
    """Rank (1 = most invocations, ties by name) and invocations.

    ``functions`` is read twice (to find the cuts between tasks, then to sort): pass a stored table."""
    ranked = global_rank(functions.select("funcName", "invocations"),
                         [F.desc("invocations"), F.asc("funcName")], "rank")
    return ranked.select("rank", "funcName", "invocations")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max (NULLs dropped), last bin right-closed.

    All bins are returned, empty ones with n = 0; all-equal values use (v − .5, v + .5).
    Bounds are one scalar-subquery row; counting is one aggregate with partial combine.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    b = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo0 = b.select("lo").scalar()
    hi0 = b.select("hi").scalar()
    lo = F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0)
    hi = F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0)
    idx = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins) + 1, F.lit(bins)).cast("int")
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(1, bins + 1).select(
        F.col("id").cast("int").alias("bin"),
        (lo + (hi - lo) * (F.col("id") - 1) / bins).alias("lo"),
        (lo + (hi - lo) * F.col("id") / bins).alias("hi"))
    return (edges.join(counts, "bin", "left")
            .select("bin", "lo", "hi", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))
