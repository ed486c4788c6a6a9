"""Operator 2: near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: round after round every shingle of a document is hashed to one of ``T`` bins, with the round number as the
leading part of its value; a bin keeps its smallest value. After a round in which all bins are filled the document
is done, so a long document takes few rounds. From round ``T`` on, round ``T + j`` sends all shingles to bin j, which
fills every bin for certain. Two documents agree in a coordinate with a probability equal to their Jaccard
similarity, concentrated as for independent hashing.

Candidates are documents that agree in all rows of a band. Documents with equal shingle sets form a class, of which
only the smallest doc_id goes on. Links are confirmed on full shingle sets in two steps, without making all pairs
of a bucket:

1. each bucket's members are compared with its smallest member (one pair a member), and confirmed links are united;
2. in buckets whose other members still lie in different components, every pair across components is compared
   inside tasks that hold two blocks of at most ``BLOCK`` members; only links that unite something are emitted.

So no candidate pair that could unite two components goes uncompared, whatever the size of a bucket. Bands and rows
follow from the threshold (``banding``): a pair at it is missed with probability below ``MISS``, 7.7e-5 at 0.85 (20 bands
of 6) and 7.3e-5 at 0.80 (24 of 5), and closer pairs far more rarely.

Defined cases: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; fewer than ``k`` words make one shingle; a null or
empty text has no shingle and is linked with nothing; repeated rows (doc_id and text) are one document and each gets a
row; a doc_id is expected to name one text; a row without a doc_id gets a null component and is kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import id_and_text, store, text_passes, text_runs
from minutewise.llm.graph import components
from minutewise.llm.wordhash import mix, shingle_hashes, word_hashes

#: Coordinates of a sketch, about, and the largest probability of missing a pair at the threshold.
T, MISS = 120, 1e-4
#: Members of a bucket that one side of a comparison task holds at most.
BLOCK = 1500
#: Members that are compared with one pivot in one task, about.
STAR = 4000
_M = (1 << 64) - 1
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def banding(pct: int) -> tuple[int, int]:
    """Bands and rows: as many rows as ``T`` coordinates allow while a pair of similarity ``pct`` % is missed with
    probability ``MISS`` at most. More coordinates where single rows don't suffice."""
    s = min(max(pct, 1), 99) / 100
    for rows in range(T // 2, 0, -1):
        if (1 - s ** rows) ** (T // rows) <= MISS:
            return T // rows, rows
    return math.ceil(math.log(MISS) / math.log(1 - s)), 1


def sketches(h: np.ndarray, at: np.ndarray, t: int = T) -> np.ndarray:
    """The (documents, t) fast similarity sketches of shingle sets; rows of empty sets mean nothing."""
    n = len(at) - 1
    out = np.full(n * t, _M, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(at))
    for i in range(2 * t):
        if not len(doc):
            break
        g = mix(h ^ np.uint64(0x9FB21C651E98DF25 * (i + 1) & _M))
        if i < t:
            bins = ((g >> _32) * np.uint64(t) >> _32).astype(np.int64)
        else:
            bins = np.full(len(g), i - t)
        np.minimum.at(out, doc * t + bins, (np.uint64(i) << _32) | (g & _LOW))
        if i < t:
            open_ = (out.reshape(n, t) == _M).any(axis=1)
            go = open_[doc]
            if not go.all():
                doc, h = doc[go], h[go]
    return out.reshape(n, t)


def band_keys(sk: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each document and band."""
    n, t = sk.shape
    rows = sk.reshape(n, bands, t // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019), (n, bands)).copy()
    for j in range(t // bands):
        key = mix(key * np.uint64(0xA24BAED4963EE407) + rows[:, :, j])
    return key


def _sums(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _sign(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch, raw, offs in text_passes(batches):
        h, at = shingle_hashes(*word_hashes(raw, offs), k)
        keys = band_keys(sketches(h, at, bands * rows), bands)
        flat = pa.array(keys.view(np.int64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at)) * bands, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array(_sums(mix(h), at).view(np.int64)),
             pa.array(_sums(mix(h ^ np.uint64(0x5851F42D4C957F2D)), at).view(np.int64)), lists],
            names=["doc_id", "n_shingles", "s1", "s2", "bands"])


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, (s1, s2): a 128-bit hash of the shingle set, bands."""
    return docs.mapInArrow(lambda it: _sign(it, k, bands, rows),
                           "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>")


def _sets(texts: list[str], k: int) -> list[np.ndarray]:
    out = []
    for raw, offs in text_runs(texts):
        h, at = shingle_hashes(*word_hashes(raw, offs), k)
        out += [h[at[i]:at[i + 1]] for i in range(len(offs) - 1)]
    return out


def _similar(one: np.ndarray, others: list[np.ndarray], pct: int) -> np.ndarray:
    """Which of ``others`` have 100 * intersection >= pct * union with ``one``."""
    if not others or not len(one):
        return np.zeros(len(others), bool)
    size = np.array([len(x) for x in others])
    ok = (100 * np.minimum(size, len(one)) >= pct * np.maximum(size, len(one))) & (size > 0)
    pick = np.flatnonzero(ok)
    if len(pick):
        flat = np.concatenate([others[i] for i in pick])
        ends = np.cumsum(size[pick])
        at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
        both = np.add.reduceat((one[at] == flat).astype(np.int64), ends - size[pick])
        ok[pick] = 100 * both >= pct * (size[pick] + len(one) - both)
    return ok


def _star(pdf: pd.DataFrame, k: int, pct: int) -> pd.DataFrame:
    """Links between the pivot of a star and its members: rows (pivot, salt, doc_id, text), the pivot's own included."""
    pivot = int(pdf["pivot"].iloc[0])
    own = pdf["doc_id"] == pivot
    rest = pdf[~own]
    texts = pdf["text"][own]
    if not len(texts) or not len(rest):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    one = _sets([texts.iloc[0]], k)[0]
    ok = []
    for s in range(0, len(rest), 256):
        ok.append(_similar(one, _sets(list(rest["text"].iloc[s:s + 256]), k), pct))
    hits = rest["doc_id"][np.concatenate(ok)]
    return pd.DataFrame({"a": np.full(len(hits), pivot, np.int64), "b": hits.to_numpy(np.int64)})


def _across(pdf: pd.DataFrame, k: int, pct: int) -> pd.DataFrame:
    """Links that unite members of one bucket, between two blocks of it (or within one)."""
    pdf = pdf.drop_duplicates(["side", "doc_id"])
    key = int(pdf["key"].iloc[0])
    left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    alone = not len(right)
    members = left if alone else pd.concat([left, right])
    ids, comp = members["doc_id"].to_numpy(), members["comp"].to_numpy().copy()
    sets = []
    for s in range(0, len(members), 256):
        sets += _sets(list(members["text"].iloc[s:s + 256]), k)
    bands = np.array(members["bands"].tolist(), np.int64).reshape(len(members), -1)
    out = []
    for i in range(len(left)):
        first = i + 1 if alone else len(left)
        same = bands[first:] == bands[i]
        # a pair is compared in the first band that both share, and not again in the others
        here = bands[i][same.argmax(axis=1)] == key
        others = first + np.flatnonzero(here & (comp[first:] != comp[i]))
        if not len(others):
            continue
        for j in others[_similar(sets[i], [sets[x] for x in others], pct)].tolist():
            if comp[i] != comp[j]:
                comp[comp == comp[j]] = comp[i]
                out.append((ids[i], ids[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, k: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    bands: int | None = None, rows: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``. Bands and rows follow from ``pct`` unless given."""
    bands, rows = (given or derived for given, derived in zip((bands, rows), banding(pct)))
    docs = id_and_text(docs, id_col, text_col)
    signed = store(signatures(docs, k, bands, rows), "op2-signed")
    classes = store(signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n_shingles")
                    .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "op2-classes")
    spread = classes.select(F.col("rep").alias("doc_id"), F.explode("bands").alias("key"))
    shared = (spread.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    buckets = store(spread.join(shared, "key"), "op2-buckets")
    wanted = buckets.select("doc_id").distinct()
    # the same plan at every size: the ids grow with the documents, so they are never broadcast
    texts = store(docs.join(wanted.hint("merge"), "doc_id", "left_semi"), "op2-texts").dropDuplicates(["doc_id"])

    # 1: each member against the smallest of its bucket
    pairs = buckets.where("doc_id <> pivot").select("pivot", "doc_id").distinct()
    width = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("salts"))
    width = store(width, "op2-pivots")
    rays = pairs.join(width, "pivot").select("pivot", F.pmod(F.xxhash64("doc_id"), "salts").cast("int").alias("salt"),
                                             "doc_id")
    hubs = width.select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                        F.col("pivot").alias("doc_id"))
    stars = rays.unionByName(hubs).join(texts, "doc_id").select("pivot", "salt", "doc_id", "text")
    links = store(stars.groupBy("pivot", "salt").applyInPandas(lambda x: _star(x, k, pct), "a long, b long"),
                  "op2-links")
    found = components(links)

    # 2: what a bucket's smallest member didn't settle
    member = (buckets.where("doc_id <> pivot").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .select("key", "doc_id", F.coalesce("root", "doc_id").alias("comp")))
    member = store(member, "op2-members")
    open_ = (member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                       F.count(F.lit(1)).alias("n")).where("lo <> hi")
             .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("doc_id"), "blocks").cast("int")
    own = member.join(open_, "key").withColumn("mine", mine)
    dealt = (own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "doc_id", "comp", F.least("mine", "other").alias("i"),
                     F.greatest("mine", "other").alias("j"),
                     F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side")))
    full = (dealt.join(texts, "doc_id")
            .join(classes.select(F.col("rep").alias("doc_id"), "bands").dropDuplicates(["doc_id"]), "doc_id"))
    more = store(full.groupBy("key", "i", "j").applyInPandas(lambda x: _across(x, k, pct), "a long, b long"),
                 "op2-across")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    # every row: its class, and the class's component
    by_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "s1", "s2", "n_shingles", F.coalesce("root", "rep").alias("comp"))
    placed = signed.select("doc_id", "n_shingles", "s1", "s2").join(by_class, ["s1", "s2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("comp")).otherwise(F.col("doc_id"))
    out = placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
