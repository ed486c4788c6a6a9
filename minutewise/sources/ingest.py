"""CSV trace ingest with a per-file ledger (idempotent, failure-isolating).

Columns are taken by the name that each file's header gives them, in any order; columns that the
trace does not know are left out, and the optional cost columns are NULL where a file lacks
them. The region comes from the directory two levels above each file (``R1_xxx/day/file.csv`` →
``R1``). A file without a header, with a declared column missing or doubled, or with any malformed
row is rejected as a whole and recorded FAILED with the reason; the others load, a file with a
header only as SUCCESS with 0 rows (Spark does not list files of 0 bytes; they leave no trace). Files whose latest ledger status is SUCCESS are skipped on
the next run, so a rerun adds nothing and a failed file can succeed later (latest status wins).

New files are taken in batches of ``files_per_batch``; the driver holds the paths and headers of
one batch. A batch reads its files twice: once for the header lines, once parsed.

Commit protocol: a batch's rows are written under ``ingest_batch=<md5 of its file list>`` (one
directory per batch) with dynamic partition overwrite, then its ledger rows are appended.
``read_table`` returns only rows of batches the ledger records, so a job that dies between the two
writes leaves no visible rows, and the retry of the same files overwrites the orphaned partition.

The ledger is a log, with a few small files for each batch. ``compact_ledger`` replaces the log so far by a snapshot
with the latest row of each file; ``read_ledger`` is the snapshot and the log since.
"""

from __future__ import annotations

import csv
import hashlib
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutewise.operators.ordering import global_rank
from minutewise.operators.selection import first_by_text_order
from minutewise.schema import COST_COLUMNS, TRACE_SCHEMA
from minutewise.session import stored
from minutewise.sources.catalog import committed_versions, current_table, drop_old_versions, publish_table

CORRUPT = "_corrupt_record"
# Fixed value: region = text before the first '_' of the directory two levels above the file
# (``R1_xxx/day/file.csv`` → R1). A Hive-style ``key=`` prefix of that directory is dropped, so a
# Spark-partitioned layout ``region=R1/day=0/part.csv`` gives R1 as well.
REGION_FROM_PATH = r"/(?:[^/=]*=)?([^/_=]*)[^/]*/[^/]+/[^/]+$"
LEDGER_SCHEMA = T.StructType([
    T.StructField("csv_file", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("imported_at", T.TimestampType()),
    T.StructField("ingest_batch", T.StringType()),
])


#: What the table holds of a request, whatever order and further columns its file has.
TABLE_SCHEMA = T.StructType([*TRACE_SCHEMA.fields, *[T.StructField(c, T.DoubleType()) for c in COST_COLUMNS]])
FILE_SCHEMA = T.StructType([T.StructField("csv_file", T.StringType()), T.StructField("header", T.StringType())])


def region_of(path):
    return F.regexp_extract(path, REGION_FROM_PATH, 1)


def header_lines(text: DataFrame) -> DataFrame:
    """(csv_file, header): the first line of each file of a ``text`` source (the first row of its first block)."""
    rows = text.select("value", F.col("_metadata.file_path").alias("csv_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_i")).where("_block = 0")
    return rows.groupBy("csv_file").agg(F.min_by("value", "_i").alias("header"))


def header_fields(header: str | None, schema: T.StructType = TRACE_SCHEMA) -> tuple[list[str], str | None]:
    """The names of a header line, and what is wrong with it (None: nothing)."""
    names = [x.strip() for x in next(csv.reader([(header or "").lstrip("\ufeff")]), [])]
    if not any(names):
        return names, "no header"
    missing = [f.name for f in schema.fields if f.name not in names]
    doubled = sorted({x for x in names if names.count(x) > 1})
    if missing:
        return names, f"columns missing: {', '.join(missing)}"
    return names, f"columns doubled: {', '.join(doubled)}" if doubled else None


def read_trace_csv(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """Files that share the header ``names``, with the trace's columns by name, file path, region and the
    malformed record if a row is one."""
    known = {f.name: f.dataType for f in TABLE_SCHEMA.fields}
    # columns the trace does not know are read as text and left out
    fields = [T.StructField(n if n in known else f"_other_{i}", known.get(n, T.StringType())) for i, n in enumerate(names)]
    df = (spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])).option("header", True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(paths))
    path = F.col("_metadata.file_path")
    return df.select(*[(F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in TABLE_SCHEMA.fields], CORRUPT, path.alias("csv_file"), region_of(path).alias("region"))


def list_csv_files(spark: SparkSession, root: str) -> DataFrame:
    """Recursive listing of ``*.csv`` under ``root`` (file metadata only, contents unread)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(root))
    return files.select(F.col("path").alias("csv_file"), "length", "modificationTime")


def latest_ledger(ledger: DataFrame) -> DataFrame:
    """Latest status per file (key = canonical path)."""
    w = Window.partitionBy("csv_file").orderBy(F.desc("imported_at"))
    return ledger.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _parquet_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows if nothing was written there yet; any other trouble is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _snapshot(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}/_latest"  # readers of the log pass over names that begin with _


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The newest snapshot, if there is one, and the log since; a row that is in both counts once."""
    log = _parquet_or_none(spark, ledger_path, LEDGER_SCHEMA)
    if not committed_versions(spark, _snapshot(ledger_path)):
        return log
    return current_table(spark, _snapshot(ledger_path)).select(*log.columns).unionByName(log).distinct()


def compact_ledger(spark: SparkSession, ledger_path: str) -> int:
    """Publish the latest row of each file as a snapshot and delete the log files that it covers; returns how many.

    Files of the log are listed before the snapshot is written, so a row that is appended meanwhile stays in the log. A
    job that dies between the two steps leaves rows in both, which read as one. Batches whose files were all tried again
    have no rows in the table and may go from the ledger. The snapshot before is kept for running queries; a query
    that has listed the log but not read it yet has to be run again. Nothing to compact: nothing changes."""
    covered = _parquet_or_none(spark, ledger_path, LEDGER_SCHEMA).inputFiles()
    if not covered:
        return 0
    publish_table(latest_ledger(read_ledger(spark, ledger_path)), _snapshot(ledger_path), partition_by=None)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name in covered:
        p = hadoop.Path(spark.sparkContext._jvm.java.net.URI(name))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    drop_old_versions(spark, _snapshot(ledger_path))
    return len(covered)


def load_files(spark: SparkSession, files: list[tuple[str, str | None]], imported_at: datetime, batch_key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of the good files of one batch, a ledger row for each of its files, and the parsed rows that both
    come from (persisted: unpersist them when both are written).

    ``files`` are paths with their header lines (bounded by the batch). Files are read header by header."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    wrong = []
    for path, header in files:
        names, problem = header_fields(header)
        if problem:
            wrong.append((path, problem))
        else:
            by_header.setdefault(tuple(names), []).append(path)
    raw = None
    for names, paths in sorted(by_header.items()):
        part = read_trace_csv(spark, paths, list(names))
        raw = part if raw is None else raw.unionByName(part)
    if raw is None:
        raw = spark.createDataFrame([], T.StructType([*TABLE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType()),
                                                      T.StructField("csv_file", T.StringType()), T.StructField("region", T.StringType())]))
    raw = raw.persist()  # parsed once, for the status and for the rows
    per = raw.groupBy("csv_file").agg(F.count(F.lit(1)).alias("rows_read"), F.min(F.substring(CORRUPT, 1, 400)).alias("bad"))
    # one row for each file of the batch, gathered once for the ledger and for the rows
    read = {r["csv_file"]: (r["rows_read"], r["bad"]) for r in per.collect()}
    problems = dict(wrong)
    listed = spark.createDataFrame([(p, problems.get(p), *read.get(p, (None, None))) for p, _ in files],
                                   "csv_file string, problem string, rows_read long, bad string").coalesce(1)
    error = F.coalesce("problem", F.concat(F.lit("malformed record: "), F.col("bad")))
    status = listed.select(
        "csv_file", region_of(F.col("csv_file")).alias("region"),
        F.when(error.isNull(), F.coalesce("rows_read", F.lit(0))).otherwise(0).cast("long").alias("row_count"),
        F.when(error.isNull(), "SUCCESS").otherwise("FAILED").alias("status"), F.substring(error, 1, 500).alias("error"),
        F.lit(imported_at).cast("timestamp").alias("imported_at"), F.lit(batch_key).alias("ingest_batch"))
    # at most one row for each file of the batch
    good = raw.join(F.broadcast(status.where("status = 'SUCCESS'").select("csv_file")), "csv_file", "left_semi")
    return good.drop(CORRUPT).withColumn("ingest_batch", F.lit(batch_key)), status, raw


def run_batch(spark: SparkSession, files: list[tuple[str, str | None]], imported_at: datetime, key: str, table_path: str,
              ledger_path: str) -> None:
    """Load one batch: rows first (replacing what an earlier attempt left), the ledger after them."""
    good, status, raw = load_files(spark, files, imported_at, key)
    (good.sortWithinPartitions("region", "clusterName", "funcName").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch").parquet(table_path))
    status.write.mode("append").parquet(ledger_path)
    raw.unpersist()


def batch_key(paths: list[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def ingest(spark: SparkSession, root: str, table_path: str, ledger_path: str, files_per_batch: int = 1000) -> DataFrame:
    """Load every CSV under ``root`` not yet loaded successfully; add good files to ``table_path`` (parquet,
    one directory per batch) and a row for every file to ``ledger_path``. Returns the ledger rows of this run.

    The file list stays a table, numbered once; each step takes the next files by their numbers."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    done = latest_ledger(read_ledger(spark, ledger_path)).where("status = 'SUCCESS'").select("csv_file")
    new = list_csv_files(spark, root).join(done, "csv_file", "left_anti").select("csv_file")
    new, first = stored(global_rank(new, ["csv_file"], "number"), "csv-files"), 1
    while found := new.where(F.col("number").between(first, first + files_per_batch - 1)).collect():
        paths, first = sorted(r["csv_file"] for r in found), first + files_per_batch
        headers = {r["csv_file"]: r["header"] for r in header_lines(spark.read.text(paths)).collect()}
        run_batch(spark, [(p, headers.get(p)) for p in paths], now, batch_key(paths), table_path, ledger_path)
    return read_ledger(spark, ledger_path).where(F.col("imported_at") == F.lit(now).cast("timestamp"))


def read_table(spark: SparkSession, table_path: str, ledger_path: str) -> DataFrame:
    """Ingested rows of committed batches only (batches present in the ledger); none if no file has loaded yet."""
    schema = T.StructType([*TABLE_SCHEMA.fields, T.StructField("csv_file", T.StringType()), T.StructField("region", T.StringType()),
                           T.StructField("ingest_batch", T.StringType())])
    committed = read_ledger(spark, ledger_path).select("ingest_batch").distinct()
    return _parquet_or_none(spark, table_path, schema).join(committed, "ingest_batch", "left_semi")


def import_totals(ledger: DataFrame) -> DataFrame:
    """Files and rows by status (latest status per file)."""
    return latest_ledger(ledger).groupBy("status").agg(F.count(F.lit(1)).alias("files"),
                                                       F.sum("row_count").alias("rows"))


def first_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """The first n rows in no stated order (not deterministic), or all rows when n is None (the default)."""
    return df if n is None else df.limit(n)


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows chosen uniformly at random (seeded).

    A Bernoulli sample that is large enough (six standard deviations above n) is stored once, and the n of its rows
    that come first by a hash of their number stay. No task meets rows of the others.
    """
    total = df.count()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    number = "_number"
    while number in {c.lower() for c in df.columns}:
        number = f"_{number}"
    for tries in range(64):
        share = min(1.0, 2 ** tries * (n + 6 * (n ** 0.5 + 6)) / total)
        drawn = df if share >= 1 else df.sample(fraction=share, seed=seed + tries)
        rows = stored(drawn.withColumn(number, F.monotonically_increasing_id()), "row-sample")
        if rows.count() >= n:
            break
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(number).cast("string")))
    return first_by_text_order(rows, n, order, F.col(number)).drop(number)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """S8 (cheap form): Bernoulli sample; size is only expected to be fraction × rows."""
    return df.sample(fraction=fraction, seed=seed)
