from pyspark.sql import functions as F

from conftest import trace_rows
from minutewise.operators import metadata as meta
from minutewise.operators import minutes as mins
from minutewise.operators import quality as qual


def _trace(spark):
    m = 60.0
    return trace_rows(spark, [
        # group A: one active minute (minute 2)
        (2 * m + 1, "R1", "c0", "fA", "p1", "u1", 0.2),
        # group B: bursts at minutes 0 and 4 with zeros between
        (0 * m + 5, "R1", "c0", "fB", "p1", "u1", 0.1),
        (0 * m + 6, "R1", "c0", "fB", "p2", "u2", 0.3),
        (4 * m + 1, "R1", "c0", "fB", "p1", "u1", 0.5),
        # NULL clusterName group
        (1 * m + 1, "R2", None, "fC", "p9", "u9", 1.0),
    ])


def test_sparse_aggregate(spark):
    sp = mins.minute_aggregate(_trace(spark)).orderBy("funcName", "minute").collect()
    b0 = [r for r in sp if r.funcName == "fB" and r.minute == 0][0]
    assert b0.requests == 2 and b0.active_pods == 2 and b0.active_users == 2
    assert abs(b0.avg_cpu - 0.2) < 1e-12


def test_dense_calendar_complete_and_conserving(spark):
    t = _trace(spark)
    sp = mins.minute_aggregate(t)
    d = mins.dense_calendar(sp)
    rows = d.collect()
    assert len(rows) == 3 * 5  # 3 groups × minutes 0..4
    assert sum(r.requests for r in rows) == 5
    a = sorted((r.minute, r.requests) for r in rows if r.funcName == "fA")
    assert a == [(0, 0), (1, 0), (2, 1), (3, 0), (4, 0)]
    c = [r for r in rows if r.funcName == "fC"]
    assert len(c) == 5 and all(r.clusterName is None for r in c) and sum(r.requests for r in c) == 1
    zero = [r for r in rows if r.funcName == "fB" and r.minute == 2][0]
    assert zero.avg_cpu == 0.0 and zero.active_pods == 0
    got = qual.assert_dense_calendar(d)
    assert got["expected_rows"] == 15 and got["invalid_groups"] == 0 and got["zero_rows"] == 11
    cons = qual.conservation(t, sp, d).first()
    assert cons.raw_requests == cons.sparse_requests == cons.dense_requests == 5


def test_dense_calendar_is_one_exchange_from_sparse(spark):
    sp = mins.minute_aggregate(_trace(spark)).checkpoint()
    d = mins.dense_calendar(sp)
    from minutewise.operators.features import feature_table
    plan = feature_table(d, group_totals=meta.group_totals(sp))._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert main.count("Exchange hashpartitioning") <= 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_hourly_bucket(spark):
    t = trace_rows(spark, [(3600.0 * 2 + 5, "R1", "c0", "f", "p", "u", 0.1)])
    assert mins.minute_aggregate(t, bucket_seconds=3600).first().minute == 2


def test_category_hot_tested_first(spark):
    stats = spark.createDataFrame([("R", "c", f"f{i}", v) for i, v in enumerate([5, 5, 5, 5])],
                                  "region string, clusterName string, funcName string, total_requests long")
    out = stats.select("*", meta.volume_category(stats).alias("category")).collect()
    # all equal: q80 = q25 = 5, Hot is tested first
    assert {r.category for r in out} == {"Hot"}


def test_stability_rule(spark):
    df = spark.createDataFrame([(0.0, None), (2.0, None), (1.0, 2.0), (2.0, 1.0)],
                               "mean_requests double, std_requests double")
    got = [r.s for r in df.select(meta.stability_rule().alias("s")).collect()]
    assert got == ["Noisy", "Stable", "Noisy", "Stable"]


def test_hot_function_does_not_skew_dense_partitions(spark):
    # one function carries a third of all requests; the dense rows per group stay equal and the
    # group partitions hold whole groups of equal length
    rows = []
    for g in range(12):
        n = 600 if g == 0 else 100
        rows += [(float(i % 60) * 60 + 1, "R1", "c0", f"f{g}", f"p{i % 7}", "u", 0.1) for i in range(n)]
    t = trace_rows(spark, rows)
    sp = mins.minute_aggregate(t).checkpoint()
    d = mins.dense_calendar(sp, partitions=4)
    per_group = {r.funcName: r.n for r in d.groupBy("funcName").agg(F.count("*").alias("n")).collect()}
    assert set(per_group.values()) == {60}
    sizes = [r.n for r in d.groupBy(F.spark_partition_id().alias("pid")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 12 * 60 and max(sizes) % 60 == 0


def test_the_calendar_gate_raises_on_a_missing_and_on_a_doubled_minute(spark):
    import pytest
    from minutewise.operators.quality import assert_dense_calendar
    rows = [("R", "c", f, m, m % 2) for f in ("f", "g") for m in range(5)]
    frame = lambda x: spark.createDataFrame(x, "region string, clusterName string, funcName string, minute int, requests long")
    assert assert_dense_calendar(frame(rows)) == {"expected_rows": 10, "invalid_groups": 0, "dense_rows": 10, "zero_rows": 6}
    for bad in (rows[:3] + rows[4:], rows + rows[2:3], rows[1:]):
        with pytest.raises(RuntimeError, match="missing or doubled"):
            assert_dense_calendar(frame(bad))
