from pyspark.sql import functions as F

from conftest import trace_rows
from minutewise.operators import features as feat
from minutewise.operators import minutes as mins


def _series(spark, counts):
    rows = []
    for minute, n in enumerate(counts):
        rows += [(minute * 60.0 + 1 + i * 0.01, "R1", "c0", "f", "p", "u", 0.4) for i in range(n)]
    return mins.minute_aggregate(trace_rows(spark, rows))


def test_lag_dense_vs_sparse(spark):
    sp = _series(spark, [5, 0, 0, 3])
    d = mins.dense_calendar(sp)
    dense = feat.feature_table(d).orderBy("minute").collect()
    assert [r.lag_1 for r in dense] == [None, 5, 0, 0]
    sparse = feat.sparse_rolling_features(sp).orderBy("minute").collect()
    assert [r.prev_requests for r in sparse] == [None, 5]
    assert [r.trend for r in sparse] == [0, -2]


def test_zero_denominators(spark):
    d = mins.dense_calendar(_series(spark, [2, 0, 4]))
    rows = feat.feature_table(d).orderBy("minute").collect()
    assert rows[0].coeff_variation is None  # std of one row is NULL
    assert rows[0].growth_rate == 0.0 and rows[0].trend == 0
    assert rows[1].cpu_per_request is None and rows[1].growth_rate == -1.0
    assert rows[2].growth_rate == 0.0  # previous minute had no load
    raw = feat.raw_variant_features(d).orderBy("minute").collect()
    assert raw[1].cpu_per_request == 0.0 and raw[0].coeff_variation == 0.0
    assert raw[0].rolling_std == 0.0  # population std of one value


def test_rolling_values(spark):
    d = mins.dense_calendar(_series(spark, [1, 2, 3, 4, 5, 6]))
    r = feat.feature_table(d).orderBy("minute").collect()[-1]
    assert r.rolling_mean_5 == 4.0 and r.rolling_max == 6 and r.rolling_min == 1
    assert r.rolling_median == 3.5 and abs(r.warm_capacity - 5.5) < 1e-12
    assert r.minute_of_hour == 5 and r.hour_of_day == 0


def test_drop_short_groups(spark):
    sp = _series(spark, [1] * 69)
    assert feat.drop_short_groups(sp, 70).count() == 0
    assert feat.drop_short_groups(sp, 69).count() == 69
