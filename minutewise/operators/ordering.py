"""Exact global ranks and running totals without funnelling a table through one task.

A window with ORDER BY and no PARTITION BY moves every row to a single partition. Here the
table is range-partitioned and sorted instead (distributed), frozen at a reliable checkpoint so
the in-partition positions are stable, and each partition gets its row offset from a table of
per-partition counts — one row per partition, the only thing that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutewise.session import materialize

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id << 33 | row in partition


def _sorted_stage(df: DataFrame, order: list[Column | str]) -> DataFrame:
    staged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = staged.withColumn("_mid", F.monotonically_increasing_id())
    staged = materialize(staged)
    return staged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))


def _partition_offsets(staged: DataFrame, measures: dict[str, Column]) -> DataFrame:
    per = staged.groupBy("_pid").agg(*[m.alias(f"_p_{k}") for k, m in measures.items()])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # rows = partitions
    return per.select("_pid", *[F.coalesce(F.sum(f"_p_{k}").over(w), F.lit(0)).alias(f"_off_{k}")
                                for k in measures])


def global_rank(df: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """Add ``name`` = 1-based position of the row in the total order ``order`` (exact, dense).

    Make ``order`` a total order (add a key tie-break) for a deterministic result.
    """
    staged = _sorted_stage(df, order)
    offs = _partition_offsets(staged, {"n": F.count(F.lit(1))})
    out = staged.join(F.broadcast(offs), "_pid")
    return out.select(*df.columns, (F.col("_off_n") + F.col("_pos") + 1).alias(name))


def running_total(df: DataFrame, order: list[Column | str], value: str, name: str = "running_total",
                  rank_name: str | None = "rank") -> DataFrame:
    """Add the inclusive running sum of ``value`` in the total order (and optionally the rank)."""
    staged = _sorted_stage(df, order)
    offs = _partition_offsets(staged, {"n": F.count(F.lit(1)), "s": F.sum(value)})
    local = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = staged.join(F.broadcast(offs), "_pid")
    cols = [*df.columns, (F.col("_off_s") + F.sum(value).over(local)).alias(name)]
    if rank_name:
        cols.append((F.col("_off_n") + F.col("_pos") + 1).alias(rank_name))
    return out.select(*cols)


def running_totals(df: DataFrame, order: list[Column | str], totals: dict[str, str]) -> DataFrame:
    """Add, for each new name of ``totals``, the inclusive running sum of the column that it stands for in the total
    order: several sums from one sorted stage."""
    staged = _sorted_stage(df, order)
    offs = _partition_offsets(staged, {name: F.sum(c) for name, c in totals.items()})
    local = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return staged.join(F.broadcast(offs), "_pid").select(
        *df.columns, *[(F.col(f"_off_{name}") + F.sum(c).over(local)).alias(name) for name, c in totals.items()])
