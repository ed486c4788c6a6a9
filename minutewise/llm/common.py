"""Helpers shared by the operators of this subpackage: tables in the shared folder, input columns, text batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutewise.session import scratch_table_path

#: Bytes of text that one numpy pass handles at a time; a longer document is a pass of its own.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: an executor that is lost later costs a re-read, not a recomputation, and later
    readers get column pruning and pushed filters.
    """
    path = scratch_table_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name`` for a column that is added to ``df``, with underscores before it while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them, without a copy; nulls are empty."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if col.null_count:  # a null may span bytes that are not its own
        return string_bytes(col.fill_null(""))
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_runs(texts: list[str], limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of runs of texts of at most ``limit`` bytes (one text at least)."""
    raw, offs = string_bytes(pa.array(texts, pa.string()))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield raw[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
        at = to


def text_passes(batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = CHUNK_BYTES
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into runs of rows of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text_col))
        raw, offs = string_bytes(col)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), raw[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
            at = to
