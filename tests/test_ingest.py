import os
import tempfile

from pyspark.sql import functions as F

from minutewise.sources import ingest as ing
from minutewise.streaming import ingest as sing

HEADER = "time_worker,time_frontend,clusterName,funcName,podID,userID,cpu_usage,memory_usage,runtimeCost,requestBodySize\n"


def _tree():
    root = tempfile.mkdtemp(prefix="mw-csv-", dir="/tmp")
    files = {
        "R1_east/day1/a.csv": HEADER + "2592000.5,,c0,f1,p1,u1,0.1,10,0.01,5\n2592061.0,,c0,f1,p2,u1,0.2,11,0.02,6\n",
        "R2_west/day1/b.csv": HEADER + "2592000.5,,c1,f2,p1,u1,0.1,10,0.01,5\nbad,,c1,f2,p1,u1,0.1,10,0.01,5\n",
        "R2_west/day1/c.csv": "time_worker,clusterName,funcName\n2592000.5,c1,f3\n",
        "R3_north/day2/d.csv": HEADER + "2592100.0,,c2,f4,p3,u3,0.3,12,0.03,7\n",
    }
    for rel, text in files.items():
        os.makedirs(os.path.join(root, os.path.dirname(rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as fh:
            fh.write(text)
    return root


def test_batch_ingest_isolates_bad_files_and_is_idempotent(spark):
    root = _tree()
    out = tempfile.mkdtemp(prefix="mw-out-", dir="/tmp")
    s1 = {os.path.basename(r.csv_file): (r.status, r.row_count, r.region)
          for r in ing.ingest(spark, root, f"{out}/t", f"{out}/l").collect()}
    assert s1 == {"a.csv": ("SUCCESS", 2, "R1"), "b.csv": ("FAILED", 0, "R2"), "c.csv": ("FAILED", 0, "R2"),
                  "d.csv": ("SUCCESS", 1, "R3")}
    s2 = ing.ingest(spark, root, f"{out}/t", f"{out}/l").collect()
    assert {os.path.basename(r.csv_file) for r in s2} == {"b.csv", "c.csv"}  # failed files retried only
    t = ing.read_table(spark, f"{out}/t", f"{out}/l")
    assert t.count() == 3
    assert {r.region: r.n for r in t.groupBy("region").agg(F.count("*").alias("n")).collect()} == {"R1": 2, "R3": 1}
    totals = {r.status: (r.files, r.rows) for r in ing.import_totals(ing.read_ledger(spark, f"{out}/l")).collect()}
    assert totals == {"SUCCESS": (2, 3), "FAILED": (2, 0)}


def test_stream_ingest_once(spark):
    root = _tree()
    out = tempfile.mkdtemp(prefix="mw-sout-", dir="/tmp")
    for _ in range(2):
        sing.stream_ingest(spark, root, f"{out}/t", f"{out}/l", f"{out}/ckpt")
    assert ing.read_table(spark, f"{out}/t", f"{out}/l").count() == 3
    status = {os.path.basename(r.csv_file): r.status for r in ing.latest_ledger(ing.read_ledger(spark, f"{out}/l")).collect()}
    assert status == {"a.csv": "SUCCESS", "b.csv": "FAILED", "c.csv": "FAILED", "d.csv": "SUCCESS"}


def _write(root, files):
    for rel, text in files.items():
        os.makedirs(os.path.join(root, os.path.dirname(rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as fh:
            fh.write(text)


def test_columns_go_by_header_name(spark):
    root, out = tempfile.mkdtemp(prefix="mw-head-", dir="/tmp"), tempfile.mkdtemp(prefix="mw-headout-", dir="/tmp")
    _write(root, {
        "R1_a/d/swapped.csv": "funcName,note,clusterName,workerCost,time_worker,time_frontend,podID,userID,cpu_usage,memory_usage,runtimeCost,requestBodySize\n"
                              'FUNC,"x,y",CLUSTER,7.5,1.0,,p,u,0.5,1,2,3\n',
        "R1_a/d/short.csv": HEADER + "1.0,,c,f\n",
        "R1_a/d/only.csv": HEADER,
        "R1_a/d/blank.csv": "\n\n",
        "R1_a/d/twice.csv": HEADER.strip() + ",podID\n1.0,,c,f,p,u,1,1,1,1,p\n",
    })
    got = {os.path.basename(r.csv_file): (r.status, r.row_count) for r in ing.ingest(spark, root, f"{out}/t", f"{out}/l", files_per_batch=2).collect()}
    assert got == {"swapped.csv": ("SUCCESS", 1), "short.csv": ("FAILED", 0), "only.csv": ("SUCCESS", 0), "blank.csv": ("FAILED", 0),
                   "twice.csv": ("FAILED", 0)}
    rows = ing.read_table(spark, f"{out}/t", f"{out}/l").collect()
    assert [(r.clusterName, r.funcName, r.workerCost, r.cpu_usage, r.region, r.busCost) for r in rows] == [("CLUSTER", "FUNC", 7.5, 0.5, "R1", None)]
    again = ing.ingest(spark, root, f"{out}/t", f"{out}/l").collect()
    assert {os.path.basename(r.csv_file) for r in again} == {"short.csv", "blank.csv", "twice.csv"}


def test_a_table_without_any_good_file_is_empty(spark):
    root, out = tempfile.mkdtemp(prefix="mw-bad-", dir="/tmp"), tempfile.mkdtemp(prefix="mw-badout-", dir="/tmp")
    assert ing.read_table(spark, f"{out}/t", f"{out}/l").count() == 0
    _write(root, {"R1_a/d/x.csv": "a,b\n1,2\n"})
    assert [r.status for r in ing.ingest(spark, root, f"{out}/t", f"{out}/l").collect()] == ["FAILED"]
    assert ing.read_table(spark, f"{out}/t", f"{out}/l").count() == 0


def test_sample_rows_exact(spark):
    df = spark.range(1000)
    assert ing.sample_rows(df, 37).count() == 37
    assert ing.sample_rows(df, 5000).count() == 1000
    assert ing.sample_rows(df, 0).count() == 0 and ing.sample_rows(df.limit(0), 3).count() == 0


def test_sample_rows_are_different_rows_drawn_evenly(spark):
    df = spark.range(0, 20_000, 1, 7).selectExpr("id", "id % 2 AS _number")
    got = ing.sample_rows(df, 4000, seed=5)
    rows = got.collect()
    assert got.columns == df.columns and len({r["id"] for r in rows}) == 4000
    assert abs(sum(r["id"] for r in rows) / 4000 - 10_000) < 500 and abs(sum(r["_number"] for r in rows) - 2000) < 200
    assert {r["id"] for r in rows} == {r["id"] for r in got.collect()}
    assert {r["id"] for r in ing.sample_rows(df, 4000, seed=6).collect()} != {r["id"] for r in rows}
    assert "TakeOrdered" not in got._jdf.queryExecution().toString()


def test_uncommitted_batch_is_invisible_and_overwritten(spark):
    root = _tree()
    out = tempfile.mkdtemp(prefix="mw-crash-", dir="/tmp")
    # a crashed run: rows of a batch written, ledger never written
    files = sorted(r.csv_file for r in ing.list_csv_files(spark, root).collect())
    good = [f for f in files if f.endswith(("a.csv", "d.csv"))]
    rows = ing.read_trace_csv(spark, good, HEADER.strip().split(","))
    (rows.drop("_corrupt_record").withColumn("ingest_batch", F.lit(ing.batch_key(files))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch").parquet(f"{out}/t"))
    assert ing.read_table(spark, f"{out}/t", f"{out}/l").count() == 0
    ing.ingest(spark, root, f"{out}/t", f"{out}/l")  # retry of the same files
    assert spark.read.parquet(f"{out}/t").count() == 3  # orphaned partition overwritten, no duplicates
    assert ing.read_table(spark, f"{out}/t", f"{out}/l").count() == 3


def test_compacted_ledger_keeps_what_is_read(spark):
    root, out = _tree(), tempfile.mkdtemp(prefix="mw-out-", dir="/tmp")
    assert ing.compact_ledger(spark, f"{out}/l") == 0  # nothing was written yet
    ing.ingest(spark, root, f"{out}/t", f"{out}/l")
    ing.ingest(spark, root, f"{out}/t", f"{out}/l")  # failed files once more
    look = lambda: ({os.path.basename(r.csv_file): (r.status, r.row_count) for r in ing.latest_ledger(ing.read_ledger(spark, f"{out}/l")).collect()},
                    ing.read_table(spark, f"{out}/t", f"{out}/l").count(),
                    {r.status: (r.files, r.rows) for r in ing.import_totals(ing.read_ledger(spark, f"{out}/l")).collect()})
    before = look()
    assert ing.read_ledger(spark, f"{out}/l").count() == 6
    assert ing.compact_ledger(spark, f"{out}/l") > 0
    assert look() == before and ing.read_ledger(spark, f"{out}/l").count() == 4
    assert ing.compact_ledger(spark, f"{out}/l") == 0 and look() == before
    # a file that is mended later loads, and the log since counts beside the snapshot
    _write(root, {"R2_west/day1/b.csv": HEADER + "2592000.5,,c1,f2,p1,u1,0.1,10,0.01,5\n"})
    again = {os.path.basename(r.csv_file): r.status for r in ing.ingest(spark, root, f"{out}/t", f"{out}/l").collect()}
    assert again == {"b.csv": "SUCCESS", "c.csv": "FAILED"}
    assert look()[1] == 4 and look()[0]["b.csv"] == ("SUCCESS", 1)
    assert ing.compact_ledger(spark, f"{out}/l") > 0 and look()[1] == 4


def test_compaction_that_dies_before_the_log_goes(spark):
    from minutewise.sources.catalog import publish_table
    root, out = _tree(), tempfile.mkdtemp(prefix="mw-out-", dir="/tmp")
    ing.ingest(spark, root, f"{out}/t", f"{out}/l")
    publish_table(ing.latest_ledger(ing.read_ledger(spark, f"{out}/l")), ing._snapshot(f"{out}/l"), partition_by=None)
    assert ing.read_ledger(spark, f"{out}/l").count() == 4  # rows of log and snapshot count once
    assert {r.status: r.files for r in ing.import_totals(ing.read_ledger(spark, f"{out}/l")).collect()} == {"SUCCESS": 2, "FAILED": 2}


def test_ledger_is_not_read_again_for_each_batch(spark, tmp_path, monkeypatch):
    from minutewise.schema import TRACE_SCHEMA
    from minutewise.sources import ingest as ing
    names = [f.name for f in TRACE_SCHEMA.fields]
    for i in range(4):
        d = tmp_path / "csv" / "R1_a" / f"day{i}"
        d.mkdir(parents=True)
        (d / "part.csv").write_text(",".join(names) + f"\n{i}.0,{i}.5,c,f,p,u,1.0,2.0,3.0,4.0\n")
    reads, real = [], ing.read_ledger
    monkeypatch.setattr(ing, "read_ledger", lambda *a: reads.append(a) or real(*a))
    got = ing.ingest(spark, str(tmp_path / "csv"), str(tmp_path / "t"), str(tmp_path / "l"), files_per_batch=1).collect()
    assert len(reads) == 2 and len(got) == 4 and {r["status"] for r in got} == {"SUCCESS"}
    assert len({r["ingest_batch"] for r in got}) == 4
    assert ing.read_table(spark, str(tmp_path / "t"), str(tmp_path / "l")).count() == 4
