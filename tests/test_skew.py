from pyspark.sql import functions as F

from minutewise.operators import skew


def _funcs(spark, values):
    return spark.createDataFrame([(f"f{i:03d}", v, 1, 1) for i, v in enumerate(values)],
                                 "funcName string, invocations long, pods long, users long")


def test_gini_equal_loads_is_zero(spark):
    assert abs(skew.gini(_funcs(spark, [5] * 9)).first().gini) < 1e-12


def test_lorenz_ends_at_one(spark):
    pts = skew.lorenz_curve(_funcs(spark, [1, 2, 3, 10])).orderBy("x").collect()
    assert (pts[0].x, pts[0].lorenz) == (0.0, 0.0) and abs(pts[-1].lorenz - 1.0) < 1e-12 and len(pts) == 5


def test_top_share_cutoffs(spark):
    for n in (1, 9, 100):
        t = skew.top_share(_funcs(spark, list(range(1, n + 1)))).first()
        total = n * (n + 1) / 2
        k10 = int(max(1, n * 0.10))
        assert abs(t.top_10_pct - sum(range(n - k10 + 1, n + 1)) / total * 100) < 1e-9


def test_category_rare_first(spark):
    out = skew.invocation_category(_funcs(spark, [4, 4, 4])).collect()
    assert {r.category for r in out} == {"Rare"}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (3.0,), (None,)], "v double")
    h = skew.histogram(df, "v", 3).orderBy("bin").collect()
    # edges 0,1,2,3: bins are [lo, hi) except the last, which is right-closed
    assert [r.n for r in h] == [2, 1, 1]
    eq = skew.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 2).orderBy("bin").collect()
    assert eq[0].lo == 1.5 and eq[-1].hi == 2.5 and sum(r.n for r in eq) == 2


def test_stability_by_median_null_cv_is_noisy(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 1.0), ("c", None)], "funcName string, cv double")
    got = {r.funcName: r.stability for r in skew.stability_by_median(df).collect()}
    assert got == {"a": "Stable", "b": "Noisy", "c": "Noisy"}


def test_skew_from_value_frequencies_equals_the_sorted_form(spark, monkeypatch):
    values = [1] * 30 + [2, 2, 7, 7, 7, 90, 0, None]
    monkeypatch.setattr(skew, "LORENZ_BLOCK", 8)  # a value's functions are expanded in several blocks
    monkeypatch.setattr(skew, "LORENZ_TASK", 10)
    xs = sorted(v or 0 for v in values)
    n, t = len(xs), sum(xs)
    pts = sorted((r.x, r.lorenz) for r in skew.lorenz_curve(_funcs(spark, values)).collect())
    want = [(0.0, 0.0)] + [((i + 1) / n, sum(xs[:i + 1]) / t) for i in range(n)]
    assert len(pts) == n + 1 and all(abs(a - c) < 1e-12 and abs(b - d) < 1e-12 for (a, b), (c, d) in zip(pts, want))
    got = skew.workload_skew(_funcs(spark, values)).first()
    assert abs(got.gini - (2 * sum((i + 1) * x for i, x in enumerate(xs)) / (n * t) - (n + 1) / n)) < 1e-12
    for p in (1, 5, 10):
        k = int(max(1, n * p / 100))
        assert abs(got[f"top_{p}_pct"] - sum(xs[-k:]) / t * 100) < 1e-9


def test_skew_of_no_functions_and_of_zeros(spark):
    assert [(r.x, r.lorenz) for r in skew.lorenz_curve(_funcs(spark, [1]).limit(0)).collect()] == [(0.0, 0.0)]
    zeros = skew.lorenz_curve(_funcs(spark, [0, 0])).orderBy("x").collect()
    assert [(r.x, r.lorenz) for r in zeros] == [(0.0, 0.0), (0.5, None), (1.0, None)]


def test_category_share_of_one_aggregate(spark):
    df = spark.createDataFrame([("Hot",), ("Rare",), ("Rare",), ("Normal",)], "category string")
    out = skew.category_share(df)
    assert {r.category: r.pct for r in out.collect()} == {"Hot": 25.0, "Rare": 50.0, "Normal": 25.0}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_sketches_roll_up_within_their_error(spark):
    from minutewise.operators import sketches
    t = spark.range(60_000).select(
        (F.col("id") % 7200).cast("double").alias("time_worker"), F.lit("R1").alias("region"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 5)).alias("funcName"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("p"), F.col("id") % 40_000)).alias("podID"), F.lit(None).cast("string").alias("userID"))
    fine = sketches.entity_sketches(t).checkpoint()
    hourly = sketches.merge_sketches(fine, F.floor(F.col("minute") / 60).alias("hour"), "funcName")
    exact = {r.funcName: r for r in t.groupBy("funcName").agg(F.count("*").alias("n"), F.countDistinct("podID").alias("pods")).collect()}
    for rolled in (sketches.estimated_entities(fine, "funcName"), sketches.estimated_entities(hourly, "funcName")):
        got = {r.funcName: r for r in rolled.collect()}
        assert got.keys() == exact.keys()
        for f, r in got.items():
            assert r.requests == exact[f].n and r.users == 0
            assert abs(r.pods - exact[f].pods) <= 6 * 1.04 / 2 ** 7 * exact[f].pods
    assert sketches.entity_sketches(t.limit(0)).count() == 0
    whole = sketches.estimated_entities(hourly).first()
    assert whole.requests == 60_000 and abs(whole.pods - t.select("podID").distinct().where("podID IS NOT NULL").count()) <= 0.05 * whole.pods
