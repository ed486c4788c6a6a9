"""Operator 11: what each of five filters removes in every order, kept up to date by an incremental stream.

The documents' files are a stream of available-now micro-batches. Each micro-batch finds the mask of failed text
filters of its rows and joins their labels. State keyed by the text (its SHA-256) holds the smallest doc_id seen so
far and the rows that have it. When a smaller id arrives, the rows counted as first of their text are retracted from
the counters of their part (-n under the old mask, +n under the mask with the duplicate filter), and the new ones take
their place. The sum of all changes is the table of counters (part, mask, labels): at most 128 rows a part. Every
order and step is worked out from it.

State is a table in the shared folder, one directory a micro-batch, to which a micro-batch adds the rows that became
first of their text; of a text's rows those with the smallest id count. Spark's own keyed state for Python functions
was tried first: it calls the function once a text, 9 ms each, hundreds of times the budget of the rest. A micro-batch
meets the state in one shuffle by text, so its cost is that of its own rows and of the state, some hundred bytes for
each distinct text; ``files_per_batch`` should grow with the table. Directories of changes and of state are
overwritten when a micro-batch is retried, and a micro-batch reads only what earlier ones wrote. Run again with the
same folder, the audit takes only files that it has not seen and corrects the counters.

Rows of one text are summed up in the map tasks before the shuffle, so a text that a third of all rows share costs
one row for each ``COMBINE_ROWS`` rows of a task. Texts are read in passes of ``CHUNK_BYTES``, a longer one in pieces.

Filters (words: maximal runs without ASCII blanks): A fewer than 50 words; B 100 * distinct words < 65 * words; C 100 *
``[A-Z]`` characters > 5 * code points; D any of ``#$%&*|``; E the text is that of a smaller doc_id. Distinct words
are told apart by 64-bit hashes.

Defined cases: a null text is empty, a null part an empty string; rows of one doc_id and text are all first or all
duplicates; a row without a doc_id neither is nor makes a duplicate; several label rows of a document count if any is
1, null labels count as 0; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minutewise.llm.common import CHUNK_BYTES, text_passes
from minutewise.llm.wordhash import NON_SPACE, prefix_hash, span_hashes, word_spans
from minutewise.session import scratch_table_path

LETTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
DUPLICATE = BIT["E"]
#: Files of a micro-batch for each core of the cluster.
FILES_A_CORE = 1
#: Rows that a map task sums up by text before it sends them.
COMBINE_ROWS = 200_000
_PARTIAL = "text_key binary, part string, mask int, good boolean, toxic boolean, first_id long, n_first long, n_all long"
_CHANGE = "part string, mask int, good boolean, toxic boolean, n long"
_FIRST = "text_key binary, first_id long, part string, mask int, good boolean, toxic boolean, n long"
_SPECIAL = np.zeros(256, bool)
_SPECIAL[list(b"#$%&*|")] = True


def _per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many of the bytes of each text are flagged."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _counts(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: capitals, code points and special characters; the words' hashes; their n + 1 offsets by text."""
    sums = np.stack([_per_text((raw >= 0x41) & (raw <= 0x5A), offs), _per_text((raw & 0xC0) != 0x80, offs),
                     _per_text(_SPECIAL[raw], offs)])
    starts, ends, at = word_spans(raw, offs, NON_SPACE)
    return sums, span_hashes(prefix_hash(raw), starts, ends), at


def _pieces(raw: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Runs of a long text that end before a blank."""
    at = 0
    while at < len(raw):
        to = at + limit
        while to < len(raw):
            blanks = np.flatnonzero(~NON_SPACE[raw[to:to + limit]])
            if len(blanks):
                to += int(blanks[0])
                break
            to += limit
        yield raw[at:to]
        at = min(to, len(raw))


def text_masks(raw: np.ndarray, offs: np.ndarray, limit: int = CHUNK_BYTES) -> np.ndarray:
    """Bits of the filters A to D that each text fails; a single text beyond ``limit`` is read in pieces."""
    if len(offs) == 2 and len(raw) > limit:
        sums, n_words, seen = np.zeros((3, 1), np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
        for piece in _pieces(raw, limit):
            more, words, _ = _counts(piece, np.array([0, len(piece)]))
            sums, n_words = sums + more, n_words + len(words)
            seen = np.union1d(seen, words)
        n_distinct = np.array([len(seen)])
    else:
        sums, words, at = _counts(raw, offs)
        n_words = np.diff(at)
        text = np.repeat(np.arange(len(n_words)), n_words)
        order = np.lexsort((words, text))
        words, text = words[order], text[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
        n_distinct = np.bincount(text[new], minlength=len(n_words))
    capitals, points, special = sums
    return (BIT["A"] * (n_words < 50) + BIT["B"] * (100 * n_distinct < 65 * n_words) + BIT["C"] * (100 * capitals > 5 * points)
            + BIT["D"] * (special > 0)).astype(np.int32)


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw, offs in text_passes(batches):
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(text_masks(raw, offs))],
                                         names=["text_key", "part", "doc_id", "mask"])


def masked_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(text_key, part, doc_id, mask): one row per document, static or streaming."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    return (rows.select(F.unhex(F.sha2("text", 256)).alias("text_key"), "part", "doc_id", "text")
            .mapInArrow(_mask, "text_key binary, part string, doc_id long, mask int"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    joined = rows.join(known, rows["doc_id"] == known["labelled"], "left")
    return joined.select("text_key", "part", "mask", "doc_id", F.coalesce("good", F.lit(False)).alias("good"),
                         F.coalesce("toxic", F.lit(False)).alias("toxic"))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal text, part, mask and labels as one: the smallest doc_id, rows that have it, and all rows."""
    keys = ["text_key", "part", "mask", "good", "toxic"]

    def summed(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        by_id = rows.group_by([*keys, "doc_id"]).aggregate([([], "count_all")])
        named = by_id.filter(pc.is_valid(by_id["doc_id"])).sort_by("doc_id")
        firsts = named.group_by(keys, use_threads=False).aggregate(
            [("doc_id", "first"), ("count_all", "first"), ("count_all", "sum")])
        nameless = by_id.filter(pc.is_null(by_id["doc_id"]))
        out = []
        # without a doc_id: none of the rows is a first one
        none = pa.chunked_array([np.zeros(nameless.num_rows, np.int64)])
        for t, cols in ((firsts, [firsts["doc_id_first"], firsts["count_all_first"], firsts["count_all_sum"]]),
                        (nameless, [none, none, nameless["count_all"]])):
            cols = [*(t[k] for k in keys), *cols]
            out += pa.table([c.cast(kind) for c, kind in zip(cols, _PARTIAL_TYPES)], names=_PARTIAL_NAMES).to_batches()
        return out

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= COMBINE_ROWS:
            yield from summed(held)
            held, n = [], 0
    if n:
        yield from summed(held)


_PARTIAL_NAMES = [c.split()[0] for c in _PARTIAL.split(", ")]
_PARTIAL_TYPES = [pa.binary(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]


def advance(partial: DataFrame, firsts: DataFrame) -> DataFrame:
    """What a micro-batch does to the state: its rows and the state's, by text, each with

    ``plain`` and ``doubled``, the changes of the counters under the row's mask and under its mask with the duplicate
    filter, and ``first``, whether it is a new row of the state.
    """
    old = firsts.select("text_key", "part", "mask", "good", "toxic", "first_id", F.col("n").alias("n_first"),
                        F.lit(0).cast("long").alias("n_all"), F.lit(True).alias("old"))
    rows = partial.withColumn("old", F.lit(False)).unionByName(old)
    text = Window.partitionBy("text_key")
    named = F.col("n_first") > 0
    rows = (rows.withColumn("least", F.min(F.when(named, F.col("first_id"))).over(text))
            .withColumn("was", F.min(F.when(F.col("old"), F.col("first_id"))).over(text)))
    least = named & (F.col("first_id") == F.col("least"))
    retracted = F.col("old") & (F.col("first_id") == F.col("was")) & (F.col("least") < F.col("was"))
    zero = F.lit(0).cast("long")
    plain = (F.when(retracted, -F.col("n_first")).when(F.col("old"), zero).when(~named, F.col("n_all"))
             .when(least, F.col("n_first")).otherwise(zero))
    doubled = (F.when(retracted, F.col("n_first")).when(F.col("old") | ~named, zero)
               .when(least, F.col("n_all") - F.col("n_first")).otherwise(F.col("n_all")))
    return rows.select("text_key", "first_id", "part", "mask", "good", "toxic", "n_first", plain.alias("plain"),
                       doubled.alias("doubled"), (~F.col("old") & least).alias("first"))


def run_audit_stream(stream: DataFrame, labels: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                     part_col: str = "source") -> None:
    """Take all files of ``stream`` not seen by the checkpoint in ``folder``; each micro-batch adds a directory to its
    ``state`` and one to its ``changes``."""
    spark = stream.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        partial = with_labels(batch, labels).mapInArrow(_combine, _PARTIAL)
        firsts = _directories(spark, f"{folder}/state", _FIRST).where(F.col("batch") < batch_id)
        rows = advance(partial, firsts).where("plain <> 0 OR doubled <> 0").persist()
        try:
            (rows.where("first").withColumnRenamed("n_first", "n").select(*firsts.columns[:-1])
             .write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}"))
            changes = rows.select("part", "good", "toxic", F.explode(F.array(
                F.struct("mask", F.col("plain").alias("n")),
                F.struct(F.col("mask").bitwiseOR(F.lit(DUPLICATE)).alias("mask"), F.col("doubled").alias("n")))).alias("c"))
            (changes.groupBy("part", "c.mask", "good", "toxic").agg(F.sum("c.n").alias("n")).where("n <> 0")
             .write.mode("overwrite").parquet(f"{folder}/changes/batch={batch_id}"))
        finally:
            rows.unpersist()

    query = (masked_rows(stream, id_col, text_col, part_col).writeStream.foreachBatch(step)
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()


def _directories(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all directories ``batch=...`` below ``path``; an empty one is made so that the path is there."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/batch=-1")
    return spark.read.schema(f"{schema}, batch long").parquet(path)


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """(part, mask, good, toxic, n): the sum of all changes."""
    changes = _directories(spark, f"{folder}/changes", _CHANGE)
    return changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").cast("long").alias("n")).where("n <> 0")


def _bits(letters: Column) -> Column:
    """The mask of all filters whose letters occur."""
    out = F.lit(0)
    for letter, bit in BIT.items():
        out = out + F.when(F.contains(letters, F.lit(letter)), bit).otherwise(0)
    return out


def interactions(counted: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counters of the masks."""
    orders = ["".join(p) for p in itertools.permutations(LETTERS)]
    rows = (counted.select("*", F.explode(F.split(F.lit(" ".join(orders)), " ")).alias("filter_order"))
            .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")))
    # a filter's bit, and those of the filters before it in the order
    rows = (rows.withColumn("bit", _bits(F.substring("filter_order", F.col("step"), F.lit(1))))
            .withColumn("before", _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~gone

    def total(of: Column, n: Column | None = None) -> Column:
        return F.sum(F.when(of, F.col("n") if n is None else n).otherwise(0)).cast("long")

    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        # of the 120 orders a filter comes first among the k that a document fails in 120 / k
        total(fails, F.col("n") * F.expr("120 div bit_count(mask)")).alias("shapley"))


def _pattern(path: str) -> str:
    """A pattern for just this path: a file stream takes a single file by pattern only, a folder either way."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path


def audit_files(spark: SparkSession, path: str, labels: DataFrame, files_per_batch: int | None = None,
                folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
                ) -> DataFrame:
    """The audit of all Parquet files under ``path``. With a ``folder`` kept from an earlier run, only files that are
    new since then are read. A micro-batch takes ``files_per_batch`` files (by default one for each core)."""
    folder = folder or scratch_table_path(spark, f"op11-{uuid.uuid4().hex}")
    files = files_per_batch or FILES_A_CORE * spark.sparkContext.defaultParallelism
    stream = (spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
              .parquet(_pattern(path)))
    run_audit_stream(stream, labels, folder, id_col, text_col, part_col)
    return interactions(counters(spark, folder))
