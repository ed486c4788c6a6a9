"""A few registered queries against their DuckDB oracles at sf0.001 (the full gate runs at
sf0.01 via tools/oracle_check.py)."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from tools.oracle_check import compare, duck

NAMES = ["minute_aggregate", "dense_calendar", "function_metadata", "feature_table", "gini", "lorenz_curve",
         "window_table", "forecast_metrics_flipped", "histogram_cv", "report"]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert msg is None, msg
