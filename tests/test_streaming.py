import tempfile

from pyspark.sql import functions as F

from conftest import trace_rows
from minutewise.streaming import minutes as smin


def test_watermark_drops_late_rows(spark):
    base = tempfile.mkdtemp(prefix="mw-stream-", dir="/tmp")
    first = trace_rows(spark, [(3600.0 * 10 + i, "R1", "c0", "f", "p", "u", 0.1) for i in range(3)])
    first.write.parquet(f"{base}/src/batch1")
    schema = first.schema
    smin.run_minute_stream(spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt", schema, watermark="1 minute")
    late = trace_rows(spark, [(5.0, "R1", "c0", "f", "p", "u", 0.1)])  # 10 h earlier than the watermark
    late.write.parquet(f"{base}/src/batch2")
    info = smin.run_minute_stream(spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt", schema, watermark="1 minute")
    res = smin.latest_minutes(spark.read.parquet(f"{base}/out")).collect()
    assert [(r.minute, r.requests) for r in res] == [(600, 3)]
    assert info["rows_dropped_by_watermark"] == 1


def test_exact_stream_merges_distinct_across_batches(spark):
    base = tempfile.mkdtemp(prefix="mw-exact-", dir="/tmp")
    a = trace_rows(spark, [(60.0 + 1, "R1", "c0", "f", "p1", "u1", 0.2), (60.0 + 2, "R1", "c0", "f", "p2", "u1", 0.4)])
    b = trace_rows(spark, [(60.0 + 3, "R1", "c0", "f", "p1", "u2", 0.6)])
    a.write.parquet(f"{base}/src/a")
    b.write.parquet(f"{base}/src/b")
    smin.run_exact_minute_stream(spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt", a.schema,
                                 max_files_per_trigger=1)
    r = smin.exact_minutes(spark, f"{base}/out").collect()
    assert len(r) == 1
    r = r[0]
    assert (r.minute, r.requests, r.active_pods, r.active_users) == (1, 3, 2, 2)
    assert abs(r.avg_cpu - 0.4) < 1e-12


def _source(spark, base, i, rows):
    part = trace_rows(spark, rows)
    part.write.parquet(f"{base}/src/part-{i}")
    return part.schema


def test_watermarked_minutes_are_exact_and_emitted_once(spark):
    base = tempfile.mkdtemp(prefix="mw-chain-", dir="/tmp")

    def run(schema):
        return smin.run_watermarked_minutes(spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt", schema, watermark="1 minute")

    def rows():
        got = smin.closed_minutes(spark, f"{base}/out").collect()
        assert len(got) == len({(r.minute, r.region, r.funcName) for r in got})  # none twice
        return {(r.minute, r.region, r.funcName, r.requests, round(r.avg_cpu, 9), r.active_pods, r.active_users) for r in got}

    schema = _source(spark, base, 0, [
        (600.0, "R1", "c0", "f", "p1", "u1", 0.2), (601.0, "R1", "c0", "f", "p2", "u1", 0.4), (602.0, None, "c0", "g", None, "u1", 0.1),
        (661.0, "R1", "c0", "f", "p1", "u1", 1.0)])
    run(schema)
    assert rows() == set()  # no minute has closed: the watermark is at 601
    # the same minutes go on in a later batch: pods and users seen before are not counted again
    _source(spark, base, 1, [(630.0, "R1", "c0", "f", "p1", "u2", 0.6), (662.0, "R1", "c0", "f", "p1", "u3", 2.0), (900.0, "R1", "c0", "f", "p9", None, 9.0)])
    run(schema)
    first = {(10, None, "g", 1, 0.1, 0, 1), (10, "R1", "f", 3, 0.4, 2, 2), (11, "R1", "f", 2, 1.5, 1, 2)}
    assert rows() == first
    # late rows of a closed minute are dropped and counted
    _source(spark, base, 2, [(605.0, "R1", "c0", "f", "p5", "u5", 5.0), (901.0, "R1", "c0", "f", "p9", "u9", 1.0)])
    assert run(schema)["rows_dropped_by_watermark"] == 3  # for the sums, the pod and the user
    smin.end_of_stream(spark, schema, after=901.0, watermark_seconds=60.0).write.parquet(f"{base}/src/end")
    run(schema)
    assert rows() == {*first, (15, "R1", "f", 2, 5.0, 1, 1)}
