from pyspark.sql import functions as F

from minutewise.operators import splits
from minutewise.operators import windows as win
from minutewise.operators.ordering import global_rank, running_total


def _features(spark, lengths):
    rows = []
    for g, n in enumerate(lengths):
        rows += [("R1", "c0", f"f{g}", m, (m % 3)) for m in range(n)]
    df = spark.createDataFrame(rows, "region string, clusterName string, funcName string, minute int, requests long")
    return df.withColumn("category", F.lit("Hot")).withColumn("stability", F.lit("Noisy"))


def test_window_counts_and_offsets(spark):
    f = _features(spark, [69, 70, 71, 72, 79])
    idx = {r.funcName: r for r in win.window_index(win.group_windows_meta(f)).collect()}
    assert "f0" not in idx
    assert [idx[k].n_windows for k in ("f1", "f2", "f3", "f4")] == [1, 2, 3, 10]
    assert [idx[k].offset for k in ("f1", "f2", "f3", "f4")] == [0, 1, 3, 6]
    assert [idx[k].group_id for k in ("f1", "f2", "f3", "f4")] == [0, 1, 2, 3]
    w = win.windows(f)
    assert w.count() == 16
    assert sorted(r.window_index for r in w.collect()) == list(range(16))
    first = w.where("funcName = 'f4' AND start = 0").first()
    assert first.origin_minute == 59


def test_split_clamps_and_sizes(spark):
    rows = [(n, s) for n in (1, 2, 10) for s in range(n)]
    df = spark.createDataFrame(rows, "n_windows long, start long")
    got = {}
    for r in splits.chronological_split(df).collect():
        got.setdefault(r.n_windows, []).append(r.split)
    assert got[1] == ["train"]
    assert sorted(got[2]) == ["train", "validation"]
    assert got[10].count("train") == 8 and got[10].count("validation") == 1 and got[10].count("test") == 1


def test_active_flag(spark):
    f = _features(spark, [70])
    w = win.windows(f).first()
    assert w.active is True


def test_arrays_shape(spark):
    f = _features(spark, [71]).withColumn("lag_1", F.lit(None).cast("long"))
    cols = ["requests", "lag_1"]
    stats = win.feature_statistics(f, cols)
    n = win.normalise(f, stats, cols)
    a = win.window_arrays(n, cols, time_features=[])
    assert a.count() == 2
    r = a.orderBy("minute").first()
    assert len(r.past_values) == 60 and len(r.past_values[0]) == 2 and len(r.target) == 10
    from minutewise.operators.quality import window_shape_violations
    assert window_shape_violations(a, n_features=2).count() == 0
    assert window_shape_violations(a, n_features=3).count() == 2  # an inner width that is wrong is seen
    assert window_shape_violations(a, history=59, n_features=2).count() == 2


def test_global_rank_and_running_total(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(200)], "v long, k long").repartition(5)
    ranked = global_rank(df, [F.col("v"), F.col("k")], "rk").orderBy("rk").collect()
    assert [r.rk for r in ranked] == list(range(1, 201))
    assert [(r.v, r.k) for r in ranked] == sorted((i % 7, i) for i in range(200))
    run = running_total(df, [F.col("k")], "v", "cum").orderBy("k").collect()
    acc = 0
    for r in run:
        acc += r.v
        assert r.cum == acc


def test_vocabulary_and_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    assert [(r.value, r.id) for r in win.vocabulary(df, "x").orderBy("id").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    c = spark.createDataFrame([("Hot",), ("Odd",), (None,)], "category string")
    assert [r.i for r in c.select(win.encode_category().alias("i")).collect()] == [2, 0, 0]
    s = spark.createDataFrame([("Stable",), ("Odd",), (None,)], "stability string")
    assert [r.i for r in s.select(win.encode_stability().alias("i")).collect()] == [0, 1, 0]
    assert [r.i for r in s.select(win.encode_stability(mode="v1").alias("i")).collect()] == [0, 0, 0]


def test_subsamples_deterministic(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(100)], "window_index long, active boolean")
    a = sorted(r.window_index for r in splits.uniform_subsample(df, 10).collect())
    b = sorted(r.window_index for r in splits.uniform_subsample(df, 10).collect())
    assert a == b and len(a) == 10
    bal = splits.balanced_subsample(df, 60, 0.8).collect()
    assert len(bal) == 60 and sum(r.active for r in bal) == 34  # only 34 active exist; rest filled
    assert splits.balanced_subsample(df, 10, 0.17).where("active").count() == 2  # 1.7 rounds up
    assert splits.balanced_subsample(df, 10, 0.25).where("active").count() == 2  # halves go to even
    train, rest = splits.v1_split(df)
    a, b = {r.window_index for r in train.collect()}, {r.window_index for r in rest.collect()}
    assert len(a) == 90 and len(b) == 10 and not a & b  # all windows, none left out


def test_numeric_classes_are_codes_already(spark):
    df = spark.createDataFrame([(2, 1), (None, None), (0, 0)], "category int, stability int")
    for mode in ("v1", "v2"):
        codes = win.encoded_classes(df, mode)
        assert [tuple(r) for r in df.select(codes["category_id"], codes["stability_id"]).collect()] == [(2, 1), (0, 0), (0, 0)]


def test_feature_statistics_fit_on_train(spark):
    f = _features(spark, [79])  # 10 windows: 8 train → rows 0..76 read by training windows
    rows = win.train_rows(f).collect()
    assert len(rows) == 8 + 69
    full = win.feature_statistics(f, ["requests"]).first()
    train = win.feature_statistics(f, ["requests"], fit_on="train").first()
    values = [m % 3 for m in range(79)]
    assert abs(full.requests_mean - sum(values) / 79) < 1e-12
    assert abs(train.requests_mean - sum(values[:77]) / 77) < 1e-12
    import pytest
    with pytest.raises(ValueError):
        win.feature_statistics(f, ["requests"], fit_on="test")


def test_selected_arrays_equal_frame_arrays(spark):
    f = _features(spark, [75, 72])
    cols = ["requests"]
    n = win.normalise(f, win.feature_statistics(f, cols), cols)
    frame = {(r.funcName, r.minute): (r.past_values, r.past_target, r.target)
             for r in win.window_arrays(n, cols, time_features=[]).collect()}
    chosen = win.windows(f).where("start % 2 = 0")
    sel = win.select_window_arrays(n, chosen, cols).collect()
    assert len(sel) == chosen.count() > 0
    for r in sel:
        assert (r.past_values, r.past_target, r.target) == frame[(r.funcName, r.origin_minute)]


def test_dense_partitions_sizing(spark):
    from minutewise.operators.minutes import dense_partitions
    sp = spark.createDataFrame([("R", "c", f"f{g}", m, 1) for g in range(40) for m in (0, 999)],
                               "region string, clusterName string, funcName string, minute int, requests long")
    # 40 groups × 1000 minutes = 40,000 dense rows
    assert dense_partitions(sp, rows_per_partition=1000) == 40       # capped at the group count
    assert dense_partitions(sp, rows_per_partition=4000) == 10
    assert dense_partitions(sp, rows_per_partition=10 ** 9) == 8    # floor: shuffle partitions
