"""Operator 10: lines that spread over many sites, found by merged HyperLogLog sketches.

Each line (split at newlines, trimmed of ASCII blanks) is keyed by two 64-bit hashes. A sketch of the sites that
carry it is built on the map side and merged by the aggregation, so a line that a third of all rows share costs one
sketch per map task. A line whose estimate lies clearly above or below ``min_sites`` is decided by it; the lines in
between get an exact distinct count of their sites. A line on ``min_sites`` sites or more is boilerplate: it stays in
the document with the smallest doc_id that has it and goes from all others.

Everything is built-in DataFrame functions; lines themselves are never shuffled, only their hashes.

Defined cases: a null or empty text has no line and stays empty; blank lines are never removed; a null site counts as
one site of its own; rows without a doc_id keep all their lines (their sites still count); repeated rows count their
site once, and all rows of one doc_id lose the same lines; an empty table gives an empty result; columns other than
the three named ones are ignored, or kept as they are by ``remove_spread_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import free_name, store

#: Sites from which a line is boilerplate.
MIN_SITES = 10
#: log2 of the sketch registers (standard error 3 %), and the share of ``min_sites`` around it that is counted exactly.
LG_K, NEAR = 10, 0.25
_BLANKS = " \t\r\x0b\x0c"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b"))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """(doc_id, site, a, b): one row per distinct line of a row, blank lines left out."""
    keys = F.transform(F.filter(F.transform(split_lines(F.col(text_col)), _trimmed), lambda x: x != ""), _key)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("null")).alias("site"),
                        F.explode(F.array_distinct(keys)).alias("k"))
            .select("doc_id", "site", "k.a", "k.b"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR, lg_k: int = LG_K) -> DataFrame:
    """(a, b, first_doc) of the lines on ``min_sites`` sites or more."""
    sketches = lines.groupBy("a", "b").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"),
                                           F.min("doc_id").alias("first_doc"))
    sized = store(sketches.select("a", "b", "first_doc", F.hll_sketch_estimate("sketch").alias("sites"))
                  .where(F.col("sites") >= min_sites * (1 - near)), "op10-sized")
    sure = sized.where(F.col("sites") > min_sites * (1 + near))
    close = sized.where(F.col("sites") <= min_sites * (1 + near))
    exact = (lines.join(close.select("a", "b"), ["a", "b"], "left_semi").select("a", "b", "site").distinct()
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites))
    close = close.join(exact.select("a", "b"), ["a", "b"], "left_semi")
    return sure.unionByName(close).select("a", "b", "first_doc")


def remove_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text",
                        site_col: str = "source", near: float = NEAR, lg_k: int = LG_K) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, plus ``_n_lines`` and ``_n_removed``; a name that
    ``docs`` has already is taken with a further underscore (``free_name``)."""
    n_lines, n_removed, id_, gone_, kept_ = (free_name(docs, c) for c in ("_n_lines", "_n_removed", "_id", "_gone", "_kept"))
    lines = lines_of(docs, id_col, text_col, site_col)
    spread = spread_lines(lines, min_sites, near, lg_k)
    gone = (lines.join(spread, ["a", "b"]).where(F.col("doc_id") > F.col("first_doc"))
            .groupBy(F.col("doc_id").alias(id_)).agg(F.collect_set(F.struct("a", "b")).alias(gone_)))
    pieces = split_lines(F.col(text_col))

    def stays(line: Column) -> Column:
        return (_trimmed(line) == "") | ~F.array_contains(F.col(gone_), _key(_trimmed(line)))

    kept = F.when(F.col(gone_).isNull(), pieces).otherwise(F.filter(pieces, stays))
    joined = docs.join(gone, F.col(id_col).cast("long") == F.col(id_), "left").withColumn(kept_, kept)
    n = F.coalesce(F.when(F.col(text_col) == "", 0).otherwise(F.size(pieces)), F.lit(0)).cast("long")
    out = (joined.withColumn(n_lines, n)
           .withColumn(n_removed, F.coalesce(F.size(pieces) - F.size(kept_), F.lit(0)).cast("long"))
           .withColumn(text_col, F.array_join(kept_, "\n")))
    return out.drop(id_, gone_, kept_)
