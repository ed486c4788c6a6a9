"""Operator 1: removal of repeated byte strings, by suffix arrays over shards of the corpus.

Every ``LENGTH``-byte string holds a smallest ``GRAM``-byte gram by hash (its anchor), and equal strings hold equal
anchors at equal offsets. So equal strings meet if each anchor, with the bytes around it that such strings can reach
(its context), goes to the shard of its gram. In numbers:

1. texts that are equal as a whole are grouped; only the one with the smallest doc_id goes on, the others are removed
   whole if they have ``LENGTH`` bytes;
2. anchors of all texts, 4 bytes each, go to shards by gram; a shard tells each text which of its grams other texts
   share. Nothing else of a text is sent further;
3. contexts of shared anchors go to their shards, equal ones of a map task as one. A shard joins its distinct contexts
   into one sequence, sorts the suffixes by two-stage sorting, computes adjacent common prefixes and so finds the
   strings that also start in a text with a smaller doc_id;
4. the byte ranges found are united for each text, and what is left of it is hashed.

A shard covers ``SHARD_BYTES`` of corpus text on average, so there are more shards as the corpus grows; texts are
shuffled once, into a bucketed table that later joins read in place. A gram that very many texts share costs a
context of 80 bytes for each distinct neighbourhood and map task, and 4 bytes for each text.

Defined cases: a null or empty text has no bytes; rows of one doc_id never remove from each other, and repeated rows
get equal results; a row without a doc_id is left whole and removes nothing; ties cannot arise, as strings must start
in a document with a strictly smaller doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import id_and_text, store, text_passes
from minutewise.llm.suffix_sort import closed, common_prefixes, two_stage_order
from minutewise.llm.wordhash import mix, powers
from minutewise.session import scratch_table_path

LENGTH = 50
GRAM = 20
#: Corpus bytes that a shard stands for on average.
SHARD_BYTES = 4 << 20
#: Text bytes whose anchors or contexts a map task gathers before it sends them.
SEND_BYTES = 8 << 20
#: Contexts whose strings are spelt out at a time.
STRIP = 1 << 15
_CTX = 2 * LENGTH - GRAM
_LEAD = LENGTH - GRAM
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _slide(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over each run of w values: out[i] = op(x[i:i + w])."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = op(x[:-step], x[step:])
        have += step
    return x


def anchors(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 64-bit hashes of the grams that are smallest in some ``LENGTH``-byte string of a document."""
    grams = len(raw) - GRAM + 1
    width = LENGTH - GRAM + 1
    if grams < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    h = mix((total[GRAM:] - total[:-GRAM]) * down[:grams])
    del total
    short = (h >> np.uint64(32)).astype(np.uint32)
    low = _slide(short, width, np.minimum)  # of the string that starts at i
    ok = np.ones(len(low), bool)
    for edge in offs[1:-1].tolist():  # strings that cross into the next document
        ok[max(0, edge - LENGTH + 1):edge] = False
    low = np.where(ok, low, np.uint32(0)).astype(np.int64)
    low[~ok] = -1
    # a gram is an anchor if it equals the smallest of a string that covers it
    padded = np.concatenate([np.full(width - 1, -1, np.int64), low, np.full(width - 1, -1, np.int64)])
    best = _slide(padded, width, np.maximum)
    pos = np.flatnonzero(best == short)
    return pos, h[pos]


def _codes(h: np.ndarray, shards: int) -> np.ndarray:
    """A gram as its shard and 32 bits that the shard doesn't follow from. Hashes of anchors are small ones, so they
    are mixed again, or the first shards would get most of them."""
    g = mix(h ^ np.uint64(0x2545F4914F6CDD1D))
    return ((g >> np.uint64(32)) * np.uint64(shards) & ~np.uint64(0xFFFFFFFF)) | (g & np.uint64(0xFFFFFFFF))


def _packed(x: np.ndarray) -> bytes:
    """Compressed bytes of an array: contexts are text, and ids and counts hold mostly zero bytes."""
    return zstandard.compress(np.ascontiguousarray(x), 1)


def _unpacked(blobs, kind) -> np.ndarray:
    """The arrays in a column of packed ones, one after another."""
    parts = [np.frombuffer(zstandard.decompress(x), kind) for x in blobs if x is not None]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _send_grams(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """(shard, docs, counts, grams): the distinct grams of a run of documents by shard, packed; of the ascending
    doc_ids the differences."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        code, doc = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, code >> np.uint64(32)))
        code, doc = code[order], doc[order]
        shard = (code >> np.uint64(32)).astype(np.int64)
        rows = []
        for part in np.split(np.arange(len(code)), np.flatnonzero(np.diff(shard)) + 1) if len(code) else []:
            d = doc[part]
            first = np.concatenate([[0], np.flatnonzero(np.diff(d)) + 1])
            rows.append((int(shard[part[0]]), _packed(np.diff(d[first], prepend=0)),
                         _packed(np.diff(np.append(first, len(d))).astype(np.int32)), code[part].astype(np.uint32).tobytes()))
        held.clear()
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                          names=["shard", "docs", "counts", "grams"])

    for batch, raw, offs in text_passes(batches):
        pos, h = anchors(raw, offs)
        row = np.searchsorted(offs, pos, "right") - 1
        code = _codes(h, shards)
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        new = np.ones(len(code), bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        ids = np.asarray(batch.column(0))
        held.append((code[new], ids[row[new]]))
        size += len(raw)
        if size >= SEND_BYTES:
            yield flush()
            size = 0
    if held:
        yield flush()


def _shared_grams(pdf: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, codes): for each document the grams of this shard that another document has too."""
    shard = np.uint64(int(pdf["shard"].iloc[0]) << 32)
    counts = _unpacked(pdf["counts"], np.int32)
    doc = np.repeat(np.concatenate([np.cumsum(_unpacked([x], np.int64)) for x in pdf["docs"]]), counts)
    gram = np.frombuffer(b"".join(pdf["grams"]), np.uint32)
    order = np.argsort(gram, kind="stable")
    g, d = gram[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    differ = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
    keep = order[np.repeat(differ, np.diff(np.append(first, len(g))))]
    doc, gram = doc[keep], gram[keep]
    order = np.argsort(doc, kind="stable")
    doc, code = doc[order], shard | gram[order].astype(np.uint64)
    if not len(doc):
        return pd.DataFrame({"doc_id": np.zeros(0, np.int64), "codes": []})
    cuts = np.flatnonzero(np.diff(doc)) + 1
    ends = np.append(cuts, len(doc))
    starts = np.append([0], cuts)
    return pd.DataFrame({"doc_id": doc[starts], "codes": [code[s:e].tobytes() for s, e in zip(starts, ends)]})


def _windows(raw: np.ndarray, pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of anchors as rows of ``_CTX`` bytes, with the bytes missing on the left and those present."""
    at = pos - _LEAD
    left = np.maximum(lo - at, 0)
    have = np.minimum(hi, at + _CTX) - (at + left)
    idx = at[:, None] + np.arange(_CTX)
    ok = (idx >= lo[:, None]) & (idx < hi[:, None])
    ctx = np.where(ok, raw[np.clip(idx, 0, max(len(raw) - 1, 0))], 0).astype(np.uint8)
    return ctx, left, have


_MULT = mix(np.arange(1, _CTX + 3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _ctx_key(ctx: np.ndarray, left: np.ndarray, have: np.ndarray) -> np.ndarray:
    """64-bit hashes of contexts, to find equal ones; equality is then confirmed on the bytes."""
    out = left.astype(np.uint64) * _MULT[-1] + have.astype(np.uint64) * _MULT[-2]
    for j in range(_CTX):
        out = mix(out + ctx[:, j] * _MULT[j]) if j % 16 == 0 else out + ctx[:, j] * _MULT[j]
    return mix(out)


def _groups(ctx: np.ndarray, left: np.ndarray, have: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A permutation by context and then document, and the starts of runs of equal contexts in it."""
    key = _ctx_key(ctx, left, have)
    order = np.lexsort((doc, key))
    k, c, a, b = key[order], ctx[order], left[order], have[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    same = np.flatnonzero(~new)
    new[same[(c[same] != c[same - 1]).any(axis=1)]] = True
    return order, np.flatnonzero(new)


def _runs(doc: np.ndarray, start: np.ndarray) -> list[tuple[int, bytes]]:
    """(doc_id, ranges): byte ranges [from, to) that strings starting at ``start`` cover, by document, united."""
    if not len(doc):
        return []
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + LENGTH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    ranges = np.stack([start[first], start[last] + LENGTH], axis=1).astype(np.int64)
    owner = doc[first]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    return [(int(owner[s]), ranges[s:e].tobytes())
            for s, e in zip(np.append([0], cuts).tolist(), np.append(cuts, len(owner)).tolist())]


def _strings(pos: np.ndarray, left: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All strings of given contexts: the context's index and the start in the document."""
    n = np.maximum(have - LENGTH + 1, 0)
    own = np.repeat(np.arange(len(pos)), n)
    off = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    return own, (pos - _LEAD + left)[own] + off


def _send_contexts(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """(shard, docs, pos, left, have, ctx, done_docs, done_pos): contexts of shared anchors by shard. Of contexts that
    are equal in this task only the smallest document's are sent; the strings of the others are known to be repeated
    and go along as ``done``."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    names = ["shard", "docs", "pos", "left", "have", "ctx", "done_docs", "done_from", "done_to"]

    def flush() -> Iterator[pa.RecordBatch]:
        shard, doc, pos, left, have, ctx = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order, first = _groups(ctx, left, have, doc)
        least = np.repeat(doc[order][first], np.diff(np.append(first, len(order))))
        later = order[doc[order] > least]
        sent = order[doc[order] == least]
        done = []
        for s in range(0, len(later), STRIP):
            part = later[s:s + STRIP]
            own, start = _strings(pos[part], left[part], have[part])
            done += _runs(doc[part][own], start)
        sent = sent[np.argsort(shard[sent], kind="stable")]
        rows = []
        for part in np.split(sent, np.flatnonzero(np.diff(shard[sent])) + 1) if len(sent) else []:
            rows.append([int(shard[part[0]]), _packed(doc[part]), _packed(pos[part].astype(np.int64)),
                         _packed(left[part].astype(np.uint8)), _packed(have[part].astype(np.uint8)),
                         _packed(ctx[part]), None, None, None])
        if done:
            # they ride on one row each, spread over the shards so that no shard gets them all
            for i, (d, r) in enumerate(done):
                span = np.frombuffer(r, np.int64).reshape(-1, 2)
                rows[i % len(rows)][6:] = [(rows[i % len(rows)][6] or b"") + np.full(len(span), d, np.int64).tobytes(),
                                           (rows[i % len(rows)][7] or b"") + span[:, 0].tobytes(),
                                           (rows[i % len(rows)][8] or b"") + span[:, 1].tobytes()]
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                         names=names)

    for batch, raw, offs in text_passes(batches):
        pos, h = anchors(raw, offs)
        row = np.searchsorted(offs, pos, "right") - 1
        lists = batch.column(2)
        packed = [b"".join(x) for x in lists.to_pylist()]
        theirs = np.frombuffer(b"".join(packed), np.uint64)
        salt = mix(np.arange(batch.num_rows, dtype=np.uint64) + np.uint64(1))
        owner = np.repeat(np.arange(batch.num_rows), [len(x) // 8 for x in packed])
        code = _codes(h, shards)
        hit = np.isin(mix(code ^ salt[row]), mix(theirs ^ salt[owner]))
        pos, code, row = pos[hit], code[hit], row[hit]
        ctx, left, have = _windows(raw, pos, offs[row], offs[row + 1])
        ids = np.asarray(batch.column(0))
        held.append(((code >> np.uint64(32)).astype(np.int64), ids[row], pos - offs[row], left, have, ctx))
        size += len(raw)
        if size >= SEND_BYTES:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, ranges): what is repeated in the contexts of one shard, and the ranges that came along."""
    def column(name, kind):
        return np.frombuffer(b"".join(x for x in pdf[name] if x is not None), kind)

    doc, pos = _unpacked(pdf["docs"], np.int64), _unpacked(pdf["pos"], np.int64)
    left, have = (_unpacked(pdf[name], np.uint8).astype(np.int64) for name in ("left", "have"))
    ctx = _unpacked(pdf["ctx"], np.uint8).reshape(-1, _CTX)
    out = []
    done = column("done_docs", np.int64), column("done_from", np.int64), column("done_to", np.int64)
    order, first = _groups(ctx, left, have, doc)
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    one = order[first]  # of each distinct context the smallest document's
    least = doc[one]
    where, ends, sym = _join(ctx[one], left[one], have[one])
    # the strings: suffixes with LENGTH symbols of their context left
    n = np.maximum(have[one] - LENGTH + 1, 0)
    of = np.repeat(np.arange(len(one)), n)
    at = where[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    string = np.full(len(sym), -1, np.int64)
    string[at] = np.arange(len(at))
    order = two_stage_order(sym, closed(sym, string >= 0))
    order = order[string[order] >= 0]
    lcp = common_prefixes(sym, order, LENGTH)
    new = np.flatnonzero(lcp < LENGTH)
    ids = string[order]
    smallest = np.empty(len(at), np.int64)
    if len(new):
        smallest[ids] = np.repeat(np.minimum.reduceat(least[of[ids]], new), np.diff(np.append(new, len(ids))))
    base = np.cumsum(n) - n
    by_doc = np.lexsort((pos, doc))
    for s in range(0, len(doc), STRIP):
        part = by_doc[s:s + STRIP]
        own, start = _strings(pos[part], left[part], have[part])
        index = base[group[part][own]] + (start - (pos[part] - _LEAD + left[part])[own])
        gone = smallest[index] < doc[part][own]
        out += _runs(doc[part][own][gone], start[gone])
    for d, a, b in zip(*(x.tolist() for x in done)):
        out.append((d, np.array([a, b], np.int64).tobytes()))
    return pd.DataFrame(out, columns=["doc_id", "ranges"])


def _join(ctx: np.ndarray, left: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts one after another with a zero after each; bytes are renumbered from 1. Starts, ends, symbols."""
    used = np.flatnonzero(np.bincount(ctx.ravel(), minlength=256) > 0)
    code = np.zeros(256, np.uint8)
    code[used] = np.arange(1, len(used) + 1) if len(used) < 256 else np.minimum(np.arange(1, 257), 255)
    cols = np.arange(_CTX)
    ok = (cols >= left[:, None]) & (cols < (left + have)[:, None])
    sym = np.zeros((len(ctx), _CTX + 1), np.uint8)
    sym[:, :_CTX] = np.where(ok, code[ctx], 0)
    keep = np.concatenate([ok, np.ones((len(ctx), 1), bool)], axis=1)
    ends = np.cumsum(have + 1)
    return ends - have - 1, ends - 1, np.concatenate([sym[keep], np.zeros(2, np.uint8)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw, offs in text_passes(batches):
        data = raw.tobytes()
        removed, spans, digest = [], [], []
        for i, lists in enumerate(batch.column(2).to_pylist()):
            text = data[offs[i]:offs[i + 1]]
            runs = np.frombuffer(b"".join(lists or []), np.int64).reshape(-1, 2)
            runs = runs[np.argsort(runs[:, 0], kind="stable")]
            kept, end, n, k = hashlib.sha256(), 0, 0, 0
            for a, b in runs.tolist():
                if a > end or k == 0:
                    kept.update(text[end:a])
                    k += 1
                    n += b - a
                    end = b
                elif b > end:
                    n += b - end
                    end = b
            kept.update(text[end:])
            removed.append(n)
            spans.append(k)
            digest.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digest)], names=["doc_id", "h1", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of ``docs``."""
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    keys = docs.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("2"), "text").alias("h2"),
                       F.octet_length("text").cast("long").alias("n_bytes"))
    small = store(keys.select("doc_id", "h1", "h2", "n_bytes", F.when((F.col("n_bytes") < LENGTH) | F.col("doc_id").isNull(),
                                                                    F.sha2("text", 256)).alias("sha")), "op1-keys")
    first = store(small.where("doc_id IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"),
                                                                            F.max("n_bytes").alias("n")), "op1-first")
    total = first.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    # the one shuffle of texts: those that go on, bucketed by doc_id
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"op1_texts_{uuid.uuid4().hex}"
    ahead = first.where(F.col("n") >= LENGTH).select(F.col("first").alias("first_id"), F.col("h1").alias("g1"),
                                                        F.col("h2").alias("g2"))
    # joined on doc_id alone, the hashes compared beside it, so that the rows lie as the buckets need them
    same = ((F.col("doc_id") == F.col("first_id")) & (F.col("h1").bitwiseXOR(F.col("g1")) == 0)
            & (F.col("h2").bitwiseXOR(F.col("g2")) == 0))
    (keys.join(ahead.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", "h1", "h2"])
     .select("doc_id", "text", "h1").write.bucketBy(parts, "doc_id").option("compression", "zstd")
     .option("path", scratch_table_path(spark, name)).saveAsTable(name))
    texts = spark.table(name)

    grams = texts.select("doc_id", "text").mapInArrow(lambda it: _send_grams(it, shards),
                                                      "shard int, docs binary, counts binary, grams binary")
    shared = grams.groupBy("shard").applyInPandas(_shared_grams, "doc_id long, codes binary")
    codes = shared.groupBy("doc_id").agg(F.collect_list("codes").alias("codes"))
    asked = texts.select("doc_id", "text").join(codes, "doc_id").select("doc_id", "text", "codes")
    contexts = asked.mapInArrow(lambda it: _send_contexts(it, shards),
                                "shard int, docs binary, pos binary, left binary, have binary, ctx binary, "
                                "done_docs binary, done_from binary, done_to binary")
    ranges = store(contexts.groupBy("shard").applyInPandas(_repeated, "doc_id long, ranges binary"), "op1-ranges")
    united = ranges.groupBy("doc_id").agg(F.collect_list("ranges").alias("ranges"))
    cut = store(texts.join(united, "doc_id", "left").select("doc_id", "text", "ranges", "h1")
                .mapInArrow(_cut, "doc_id long, h1 long, n_removed long, n_spans long, kept_sha256 string"), "op1-cut")
    spark.sql(f"DROP TABLE {name}")

    placed = small.join(first.select("h1", "h2", "first"), ["h1", "h2"], "left").join(cut, ["doc_id", "h1"], "left")
    whole = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    return placed.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("sha", "kept_sha256")).alias("kept_sha256"))
