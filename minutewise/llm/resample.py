"""Operator 13: importance resampling of documents towards a target distribution of hashed n-grams.

Features of a text are all runs of 1 to ``n`` consecutive words, each hashed by the CRC-32 of its bytes into a fixed
number of buckets. The log ratio of a bucket's share in the target and in the corpus is its gain; the mean gain of a
document's features is its importance weight, and Gumbel noise seeded by its doc_id turns the highest scores into a
draw without replacement.

Features are found for a batch of texts at a time: the texts are joined with a separator that no word holds, one
regular expression pass finds all words of the batch, and a search in the documents' offsets tells the document of
each word, so that runs across two documents are masked before the buckets are counted. A pass takes ``CHUNK_BYTES``
of text; a longer text goes through in pieces that overlap by ``n - 1`` words, so memory does not grow with it.

The corpus is read twice, once for the bucket counts (one row a bucket and task, added up by Spark) and once for the
weights. Only the counts, one number a bucket, pass through the driver. The draw ranks narrow rows by range
partitions; no task sees all of them.

Defined cases: a null or empty text has no word, weight 0 and is never drawn while ``min_words`` is above 0; equal
scores go by the smaller doc_id, rows without a doc_id last; rows of one doc_id are scored and drawn row by row; an
empty table gives an empty result, an empty target gains of an empty target (t = T = 0); other columns are ignored by
``importance_scores`` and kept as they are by ``resampled``, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import CHUNK_BYTES, id_and_text, store
from minutewise.operators.ordering import global_rank

BUCKETS = 10_000
#: Longest run of words that is a feature.
NGRAM = 2
#: Percentage of the documents with ``MIN_WORDS`` words or more that is drawn.
SHARE, MIN_WORDS = 25, 20
SEED = 7
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_SEP = b"\n"
#: Words up to this length are hashed a byte position at a time for all words together, longer ones singly.
_LONG = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def crc_extend(crc: np.ndarray, buf: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of byte strings that begin with something of checksum ``crc`` and go on with buf[starts:ends]."""
    raw = np.frombuffer(buf, np.uint8)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    size, at = size[order], starts[order]
    state = ~crc[order].astype(np.uint32)
    n_long = int(np.searchsorted(-size, -_LONG, "left"))
    for i in range(n_long):
        state[i] = ~np.uint32(zlib.crc32(buf[at[i]:at[i] + size[i]], int(~state[i])))
    size, at, short = size[n_long:], at[n_long:], state[n_long:]
    for k in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -k, "left"))
        s = short[:live]
        short[:live] = _CRC[(s ^ raw[at[:live] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    return out


def word_spans(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words of a lower-cased buffer, by one pass of the regular expression."""
    flat = np.fromiter((x for m in _WORD.finditer(buf) for x in m.span()), np.int64)
    return flat[::2], flat[1::2]


def batch_features(buf: bytes, offs: np.ndarray, buckets: int = BUCKETS, n: int = NGRAM, carried: int = 0
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document and bucket of each feature of the joined texts of a batch, the document of each word, and word starts.

    ``offs`` holds the start of each document in ``buf``. The first ``carried`` words were part of an earlier piece of
    the same document: only runs that end behind them count.
    """
    starts, ends = word_spans(buf)
    doc = np.searchsorted(offs, starts, "right") - 1
    crc = crc_extend(np.zeros(len(starts), np.uint32), buf, starts, ends)
    docs, hashes = [doc[carried:]], [crc[carried:]]
    for k in range(1, n):
        if len(starts) <= k:
            break
        spaced = ~crc[:-1]
        spaced = ~(_CRC[(spaced ^ np.uint32(0x20)) & np.uint32(255)] ^ (spaced >> np.uint32(8)))
        crc = crc_extend(spaced, buf, starts[k:], ends[k:])
        inside = doc[k:] == doc[:-k]
        inside[:max(0, carried - k)] = False
        docs.append(doc[k:][inside])
        hashes.append(crc[inside])
    return np.concatenate(docs), (np.concatenate(hashes) % np.uint32(buckets)).astype(np.int64), doc[carried:], starts


def _passes(texts: list[bytes], limit: int) -> Iterator[tuple[int, int, bytes, np.ndarray, bool]]:
    """(first, last, buffer, offsets, whole): runs of texts joined by the separator, or one long text by itself."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if len(t) > limit:
            if first < i:
                yield _joined(texts, first, i)
            yield i, i + 1, t.lower(), np.zeros(1, np.int64), False
            first, size = i + 1, 0
            continue
        if size + len(t) > limit and first < i:
            yield _joined(texts, first, i)
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield _joined(texts, first, len(texts))


def _joined(texts: list[bytes], first: int, last: int) -> tuple[int, int, bytes, np.ndarray, bool]:
    run = texts[first:last]
    sizes = np.fromiter((len(t) + len(_SEP) for t in run), np.int64, len(run))
    return first, last, _SEP.join(run).lower(), np.cumsum(sizes) - sizes, True


def features(texts: list[bytes], buckets: int = BUCKETS, n: int = NGRAM, limit: int = CHUNK_BYTES
             ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, document, bucket, document of each word) for runs of texts; documents are counted from first."""
    for first, last, buf, offs, whole in _passes(texts, limit):
        if whole:
            yield first, last, *batch_features(buf, offs, buckets, n)[:3]
            continue
        at, carried, to = 0, 0, 0
        while to < len(buf):
            gap = _GAP.search(buf, min(max(at + limit, to + 1), len(buf)))
            to = gap.start() if gap else len(buf)
            docs, hashed, words, starts = batch_features(buf[at:to], offs, buckets, n, carried)
            yield first, last, docs, hashed, words
            carried = min(n - 1, len(starts))
            at = at + int(starts[-carried]) if carried else to


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    col = batch.column(batch.schema.get_field_index("text"))
    return pc.fill_null(col.cast(pa.large_binary()), b"").to_pylist()


def _count(batches: Iterator[pa.RecordBatch], buckets: int, n: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, _, hashed, _ in features(_texts(batch), buckets, n):
            total += np.bincount(hashed, minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, n: int = NGRAM) -> DataFrame:
    """(bucket, n): features of a column ``text`` by bucket; one row a bucket and task is shuffled."""
    parts = texts.select("text").mapInArrow(lambda it: _count(it, buckets, n), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Floored 1000 * log ratio of the smoothed shares of each bucket."""
    s_all, t_all = sum(corpus.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log((float(target.get(b, 0) + 1) * float(s_all + buckets))
                                                / (float(corpus.get(b, 0) + 1) * float(t_all + buckets))))
                     for b in range(buckets)], np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        words, count, total = (np.zeros(rows, np.int64) for _ in range(3))
        for first, last, docs, hashed, of_word in features(_texts(batch), len(gain), n):
            size = last - first
            words[first:last] += np.bincount(of_word, minlength=size)
            count[first:last] += np.bincount(docs, minlength=size)
            # sums of small whole numbers, exact in doubles
            total[first:last] += np.bincount(docs, weights=gain[hashed], minlength=size).astype(np.int64)
        weight = np.where(count > 0, total // np.maximum(count, 1), 0)
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(words),
                                          pa.array(count), pa.array(weight)],
                                         names=["doc_id", "n_words", "n_features", "weight"])


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) of a key: the same at every run and partitioning."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_scores(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS,
                      seed: int = SEED, buckets: int = BUCKETS, n: int = NGRAM, id_col: str = "doc_id",
                      text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) for each row of ``docs``."""
    docs = id_and_text(docs, id_col, text_col)
    wanted = target.select(F.coalesce(F.col(target_col).cast("string"), F.lit("")).alias("text"))
    both = (bucket_counts(docs, buckets, n).withColumn("target", F.lit(False))
            .unionByName(bucket_counts(wanted, buckets, n).withColumn("target", F.lit(True))))
    counts: dict[bool, dict[int, int]] = {False: {}, True: {}}
    for r in both.collect():  # two numbers a bucket
        counts[r["target"]][r["bucket"]] = r["n"]
    gain = gains(counts[False], counts[True], buckets)
    weighed = docs.mapInArrow(lambda it: _weigh(it, gain, n), "doc_id long, n_words long, n_features long, weight long")
    scored = store(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "op13-scored")
    able = scored.where(F.col("n_words") >= min_words)
    draws = able.count() * share // 100
    ranked = global_rank(able, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")], "rank")
    rank = F.when(F.col("rank") <= draws, F.col("rank")).cast("long")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, with all their columns and no other."""
    drawn = (importance_scores(docs, target, id_col=id_col, text_col=text_col, **options)
             .where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__drawn")).distinct())
    return docs.join(drawn.hint("merge"), docs[id_col].cast("long").eqNullSafe(drawn["__drawn"]), "left_semi")
