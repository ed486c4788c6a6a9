"""Order statistics, quantiles and exact samples by counting, against sorting; the plans hold no percentile."""

import hashlib
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from minutewise.operators import features as feat
from minutewise.operators import selection as sel


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(4)


@pytest.mark.parametrize("kind", ["ties", "spread", "tiny", "one", "signed"])
def test_order_statistics_equal_sorting(spark, kind):
    rng = random.Random(kind)
    values = {"ties": [float(rng.randrange(4)) for _ in range(400)],
              "spread": [math.exp(rng.uniform(-300, 300)) for _ in range(300)],
              "tiny": [1.0 + rng.randrange(3) * 2 ** -52 for _ in range(200)],
              "one": [7.5], "signed": [rng.gauss(0, 1e308) for _ in range(200)]}[kind]
    values = [v for v in values if math.isfinite(v)]
    df = _frame(spark, [*values, None])
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    want = [sorted(values)[r] for r in ranks]
    assert sel.order_statistics(df, "v", ranks) == want
    assert sel.order_statistics(df, "v", ranks, bins=7, few=5) == want  # many passes


def test_quantiles_equal_percentile(spark):
    rng = random.Random(1)
    df = _frame(spark, [float(rng.choice([0, 0, 1, 5, rng.randrange(1000)])) for _ in range(997)])
    qs = [0.0, 0.2, 0.25, 0.5, 0.8, 0.99, 1.0]
    want = df.select(F.percentile("v", F.array(*map(F.lit, qs)))).first()[0]
    assert sel.exact_quantiles(df, "v", qs) == pytest.approx(want, rel=1e-15)
    assert sel.exact_quantiles(df, "v", qs, bins=5, few=3) == pytest.approx(want, rel=1e-15)


def test_quantiles_of_nothing_and_of_what_is_not_finite(spark):
    assert sel.exact_quantiles(_frame(spark, [None, None]), "v", [0.5]) == [None]
    for bad in (math.nan, math.inf):
        with pytest.raises(ValueError):
            sel.exact_quantiles(_frame(spark, [1.0, bad]), "v", [0.5])
    with pytest.raises(ValueError):
        sel.order_statistics(_frame(spark, [1.0]), "v", [1])


def test_first_by_text_order_is_the_sorted_head(spark):
    df = spark.range(3000).withColumn("wide", F.repeat(F.lit("x"), 100))
    order = sorted(range(3000), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    text = F.md5(F.col("id").cast("string"))
    for m, few in ((0, 10), (1, 1), (700, 50), (700, 20_000), (3000, 5), (5000, 5)):
        got = sel.first_by_text_order(df, m, text, F.col("id"), few)
        assert sorted(r["id"] for r in got.collect()) == sorted(order[:m])
    # equal digests are told apart by the key
    same = sel.first_by_text_order(df, 10, F.md5(F.lit("a")), F.col("id"), few=4)
    assert sorted(r["id"] for r in same.collect()) == list(range(10))


def test_frame_quantiles_equal_percentile(spark):
    rng = random.Random(3)
    rows = [("r", "c", f"f{g}", m, rng.choice([0, 0, 0, rng.randrange(50)]) if g else rng.choice([None, 0, 3]))
            for g in range(3) for m in range(90)]
    df = spark.createDataFrame(rows, "region string, clusterName string, funcName string, minute int, requests long")
    w = Window.partitionBy(*feat.KEY).orderBy("minute").rowsBetween(-29, 0)
    out = (df.select("*", *feat.nonzero_values(F.col("requests"), w),
                     F.percentile("requests", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.37))).over(w).alias("want"))
           .withColumn("_sorted", F.sort_array("_above"))
           .select("want", F.array(*[feat.frame_quantile(q) for q in (0.5, 0.9, 0.37)]).alias("got")))
    for r in out.collect():
        assert r["got"] == (pytest.approx(r["want"], rel=1e-14) if r["want"] is not None else [None] * 3)


def test_no_percentile_is_left_in_the_plans(spark):
    from conftest import SF001
    from minutewise.plans.registry import load_all
    queries = load_all()
    for name in ("invocation_category", "stability_by_median", "function_metadata", "feature_table", "function_codes",
                 "sparse_rolling_features", "forecast_record"):
        plan = queries[name][0](spark, SF001)._jdf.queryExecution().toString()
        assert "percentile" not in plan, name
