import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from minutewise.plans.report import report, write_report_text
from minutewise.sources import catalog as cat
from minutewise.sources.fixture import trace


def test_views_tables_and_statistics(spark):
    t = trace(spark, SF001)
    cat.register_view(t, "requests_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM requests_view").first().n == t.count()
    base = tempfile.mkdtemp(prefix="mw-cat-", dir="/tmp")
    cat.replace_table(t, f"{base}/requests", sort_within=["region", "clusterName", "funcName", "time_worker"])
    cat.replace_table(t, f"{base}/requests")  # replace is idempotent
    assert spark.read.parquet(f"{base}/requests").count() == t.count()
    cat.save_table(t.select("region", "funcName", "cpu_usage"), "requests_small", path=f"{base}/small")
    assert cat.table_exists(spark, "requests_small")
    assert "requests_small" in cat.list_tables(spark)
    assert [c for c, _ in cat.describe(spark, "requests_small")] == ["region", "funcName", "cpu_usage"]
    desc = {r.col_name: r.data_type for r in cat.analyze(spark, "requests_small").collect()}
    assert "Statistics" in desc


def test_published_versions_survive_a_write_that_fails(spark):
    base = tempfile.mkdtemp(prefix="mw-pub-", dir="/tmp")
    path = f"{base}/t"
    with pytest.raises(FileNotFoundError):
        cat.current_table(spark, path)
    rows = spark.range(40).select((F.col("id") % 4).alias("region"), F.col("id").alias("v"))
    cat.publish_table(rows, path)
    assert cat.current_table(spark, path).agg(F.sum("v")).first()[0] == 780
    # the third task fails after others have written their files
    bad = rows.repartition(4, "v").withColumn("v", F.when(F.col("v") == 33, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        cat.publish_table(bad, path)
    assert cat.current_table(spark, path).agg(F.sum("v")).first()[0] == 780
    # a new version may be made from the table itself, and one that reads the old keeps its files
    old = cat.current_table(spark, path)
    cat.publish_table(old.select("region", (F.col("v") + 1).alias("v")), path)
    assert (old.count(), cat.current_table(spark, path).agg(F.sum("v")).first()[0]) == (40, 820)
    assert cat.drop_old_versions(spark, path, keep=1) == 1 and cat.drop_old_versions(spark, path, keep=1) == 0
    assert cat.current_table(spark, path).count() == 40
    with pytest.raises(ValueError):
        cat.drop_old_versions(spark, path, keep=0)


def test_lookup_reads_one_bucket(spark):
    base = tempfile.mkdtemp(prefix="mw-store-", dir="/tmp")
    rows = [(r, c, f, m, m * 2) for r in ("R1", None) for c in ("c0", None) for f in ("f0", "f1", "f2", "c0") for m in range(20)]
    df = spark.createDataFrame(rows, "region string, clusterName string, funcName string, minute int, requests long")
    cat.save_feature_store(df, "mw_feature_store", f"{base}/s", buckets=8)
    try:
        got = cat.lookup_group(spark, "mw_feature_store", "R1", None, "c0")
        assert [tuple(r) for r in got.collect()] == [r for r in rows if r[:3] == ("R1", None, "c0")]
        assert "EqualTo(group_key,R1::c0)" in got._jdf.queryExecution().executedPlan().toString()
        mine = spark.table("mw_feature_store").where("group_key = 'R1::c0'").select(F.input_file_name()).distinct().collect()
        assert len(mine) == 1
        # no other bucket is opened: they could be anything
        for name in os.listdir(f"{base}/s"):
            if name.endswith(".parquet") and not mine[0][0].endswith(name):
                with open(f"{base}/s/{name}", "w") as f:
                    f.write("no parquet")
        assert cat.lookup_group(spark, "mw_feature_store", "R1", None, "c0").count() == 20
        with pytest.raises(Exception):
            spark.table("mw_feature_store").agg(F.sum("requests")).collect()
    finally:
        spark.sql("DROP TABLE mw_feature_store")


def test_csv_and_text_sinks(spark):
    base = tempfile.mkdtemp(prefix="mw-sink-", dir="/tmp")
    t = trace(spark, SF001)
    cat.write_csv(t.groupBy("region").count(), f"{base}/regions")
    assert spark.read.option("header", True).csv(f"{base}/regions").count() == 5
    rep = report(t)
    write_report_text(rep, f"{base}/report")
    lines = spark.read.text(f"{base}/report").collect()
    assert len(lines) == rep.count() and any("DATASET SUMMARY | Requests:" in r.value for r in lines)


def test_scratch_tables_can_be_dropped(spark, monkeypatch):
    from minutewise import session
    root = session.scratch_root(spark)
    assert session.scratch_table_path(spark, "x").startswith(root) and spark.sparkContext.applicationId in root
    monkeypatch.setattr(session, "scratch_root", lambda s: f"{root}-other")
    back = session.stored(spark.range(10), "numbers")
    assert back.count() == 10
    assert session.drop_scratch(spark) and not session.drop_scratch(spark)
