import __spark_entry__ as E
from conftest import SF001


def test_contract_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80
    assert "feature_table" in qs and "feature_table" in sql


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "warm_capacity" in df.columns and df.count() > 0


def test_no_python_udfs_in_plans(spark):
    for name in ("feature_table", "forecast_metrics", "report", "window_table", "raw_trace_features"):
        # at sf0.001 no group reaches 70 active minutes, and the raw path rightly refuses it
        sf = "/root/testdata/sf0.01" if name == "raw_trace_features" else SF001
        plan = E.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
