"""Catalog access and table sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutewise.schema import KEY


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Named temp view over a source."""
    df.createOrReplaceTempView(name)
    return df


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = ("region",),
                  sort_within: list[str] | None = None) -> None:
    """Replace a table stored as parquet (DROP + CREATE AS SELECT), partitioned by region;
    ``sort_within`` orders rows inside files (row-group statistics for key lookups) without a
    global sort."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def committed_versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed versions below ``path``, oldest first."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    return [n for n in names if n.startswith("version-")
            and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


def publish_table(df: DataFrame, path: str, partition_by: list[str] | None = ("region",), sort_within: list[str] | None = None) -> str:
    """S10 without a gap: write ``df`` as a new version beside those that are there; returns its path.

    A version counts from the moment that its commit marker (``_SUCCESS``) is there, which is one atomic step on file
    systems and object stores alike. Until then, and if the write fails half-way, ``current_table`` reads the version
    before; a query that is running keeps its files until ``drop_old_versions``. So ``df`` may read the table itself.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    last = committed_versions(spark, path)
    number = int(last[-1].split("-")[1]) + 1 if last else 1
    new = f"{path}/version-{number:010d}-{uuid.uuid4().hex}"
    # the marker of a half-written partitioned write must not count: it is written by the job's commit alone
    w = (df.sortWithinPartitions(*sort_within) if sort_within else df).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(new)
    return new


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of a published table."""
    path = path.rstrip("/")
    versions = committed_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no version of {path} is committed")
    return spark.read.parquet(f"{path}/{versions[-1]}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest committed versions; returns how many went. Uncommitted directories stay:
    another writer may be at work on them."""
    path = path.rstrip("/")
    if keep < 1:
        raise ValueError("the current version has to stay")
    old = committed_versions(spark, path)[:-keep]
    for name in old:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(old)


def save_feature_store(features: DataFrame, name: str, path: str, buckets: int) -> None:
    """F25 for lookups (D18): the feature table bucketed by group and sorted by group and minute, so that one group is
    one bucket and a few row groups of its file. ``buckets`` sets the file size: about rows / 2 million for wide rows."""
    keyed = features.withColumn("group_key", F.concat_ws("::", *KEY)).repartition(buckets, "group_key")
    (keyed.write.mode("overwrite").format("parquet").bucketBy(buckets, "group_key").sortBy("group_key", "minute")
     .option("path", path).saveAsTable(name))


def lookup_group(spark: SparkSession, name: str, region: str | None, cluster: str | None, func: str | None) -> DataFrame:
    """One group's rows of a feature store in minute order; only the group's bucket is read. The columns beside the
    joined key tell groups with NULLs in their keys apart."""
    values = dict(zip(KEY, (region, cluster, func)))
    key = "::".join(v for v in values.values() if v is not None)
    rows = spark.table(name).where(F.col("group_key") == key)
    for c, v in values.items():
        rows = rows.where(F.col(c).eqNullSafe(F.lit(v)))
    return rows.drop("group_key").orderBy("minute")


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """S10 (catalog form): overwrite a named table (e.g. to ANALYZE it)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV result sink with header (written by the executors, no driver collect)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def list_tables(spark: SparkSession) -> list[str]:
    """S12."""
    return [t.name for t in spark.catalog.listTables()]


def describe(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """Column names and types."""
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]


def table_exists(spark: SparkSession, name: str) -> bool:
    """S12."""
    return spark.catalog.tableExists(name)


def analyze(spark: SparkSession, name: str) -> DataFrame:
    """Table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
