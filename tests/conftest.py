import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from minutewise.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="minutewise-tests")
    yield s
    s.stop()


def trace_rows(spark, rows):
    """rows: (time_worker, region, clusterName, funcName, podID, userID, cpu) tuples."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("time_worker", T.DoubleType()), T.StructField("region", T.StringType()),
        T.StructField("clusterName", T.StringType()), T.StructField("funcName", T.StringType()),
        T.StructField("podID", T.StringType()), T.StructField("userID", T.StringType()),
        T.StructField("cpu_usage", T.DoubleType()), T.StructField("memory_usage", T.DoubleType()),
        T.StructField("runtimeCost", T.DoubleType()), T.StructField("requestBodySize", T.DoubleType()),
    ])
    full = [(t, r, c, f, p, u, cpu, 1.0, 0.5, 10.0) for (t, r, c, f, p, u, cpu) in rows]
    return spark.createDataFrame(full, schema)
