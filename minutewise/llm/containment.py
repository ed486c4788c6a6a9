"""Operator 8: test items inside long documents, by size-partitioned MinHash containment search.

Documents fall into size classes by powers of two of their distinct 5-word shingles. A class whose documents have
up to 2^(c+1) shingles uses one-permutation MinHash with 2^(c+2) bins: the sketch grows with the class, so a short
item inside a long document still meets it. A shingle that item and document share is the minimum of its bin in
both with probability over 0.78, so an item of which 80 % is contained is missed by one hash function with
probability 0.22^(0.8 n). The number of hash functions follows from the smallest item, to make that less than
``MISS``. Each candidate is then verified by exact containment of word shingles.

Items are held in blocks of at most ``BLOCK_BYTES`` of text, which is what a broadcast holds at most (plus one item);
more items mean more passes over the documents. Documents are never shuffled.

Defined cases: words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased. An item with
fewer than 5 words is one shingle, its whole sequence; items and documents without words match nothing; a null text
is empty; each row of a repeated document or item is reported by itself; a null id is reported as null; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import id_and_text, text_passes
from minutewise.llm.wordhash import ALNUM, mix, shingle_hashes, word_hashes, word_spans

K = 5
#: Contained: NUM * shared >= DEN * item size.
DEN, NUM = 4, 5
BLOCK_BYTES = 4 << 20
MISS = 1e-9
_SEED = 0x8F1BBCDC5A827999
SCHEMA = "doc_id long, item_id long, n_item long, n_shared long"


def _permuted(h: np.ndarray, r: int) -> np.ndarray:
    """The r-th hash function; the 0-th keeps the shingle hashes."""
    return h if r == 0 else mix(h ^ np.uint64(_SEED * (2 * r + 1) % (1 << 64)))


def _shared_bits(a: np.ndarray) -> np.ndarray:
    """Leading bits that each value of a sorted array shares with the one before it (-1 at the start)."""
    out = np.full(len(a), -1, np.int64)
    if len(a) > 1:
        x = a[1:] ^ a[:-1]
        hi, lo = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
        out[1:] = np.where(hi > 0, 32 - np.frexp(hi)[1], 64 - np.frexp(lo)[1])
    return out


def exact_shingles(text: str) -> set[tuple[bytes, ...]]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), ALNUM)
    data = raw.tobytes().lower()
    words = [data[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
    if len(words) < K:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(K))))


class ItemBlock:
    """A bounded set of items: for each hash function the sorted sketch values, with the item and the smallest bin
    count in bits at which the value is its item's minimum."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids = [r[0] for r in rows]
        self.sets = [exact_shingles(r[1]) for r in rows]
        data = [r[1].encode("utf-8", "surrogatepass") for r in rows]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        h, at = shingle_hashes(*word_hashes(np.frombuffer(b"".join(data), np.uint8), offs, ALNUM), K)
        self.hashes = [h[at[i]:at[i + 1]] for i in range(len(rows))]
        sizes = [len(x) for x in self.sets if x]
        least = math.ceil(DEN * min(sizes, default=1) / NUM)
        self.functions = max(1, math.ceil(math.log(MISS) / (least * math.log(0.22))))
        self.index = []
        for r in range(self.functions):
            g, item, bits = [], [], []
            for i, x in enumerate(self.hashes):
                y = np.sort(_permuted(x, r))
                g.append(y)
                item.append(np.full(len(y), i))
                bits.append(_shared_bits(y))
            g, item, bits = (np.concatenate([np.zeros(0, t), *x]).astype(t)
                             for x, t in ((g, np.uint64), (item, np.int64), (bits, np.int64)))
            order = np.argsort(g, kind="stable")
            self.index.append((g[order], item[order], bits[order]))


def _candidates(block: ItemBlock, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(document, item) pairs, as document * items + item, that meet in a bin of some hash function."""
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    # size class by distinct shingles; a class has 2^(c + 2) bins
    need = (np.frexp(np.maximum(n, 1).astype(np.float64))[1] + 1)[doc]
    found = []
    for r, (values, items, bits) in enumerate(block.index):
        g, d, b = _permuted(h, r), doc, need
        if r:
            order = np.lexsort((g, doc))
            g, d, b = g[order], doc[order], need[order]
        same = np.zeros(len(g), bool)
        same[1:] = d[1:] == d[:-1]
        smallest = ~same | (_shared_bits(g) < b)
        g, d, b = g[smallest], d[smallest], b[smallest]
        lo = np.searchsorted(values, g, "left")
        hit = np.flatnonzero((lo < len(values)) & (values[np.minimum(lo, len(values) - 1)] == g)) if len(values) else []
        if len(hit) == 0:
            continue
        lo, width = lo[hit], np.searchsorted(values, g[hit], "right") - lo[hit]
        at_value = np.repeat(lo, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        d, b = np.repeat(d[hit], width), np.repeat(b[hit], width)
        ok = bits[at_value] < b  # the value is the minimum of its bin in the item too
        found.append(np.unique(d[ok] * len(block.ids) + items[at_value[ok]]))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _hits(block: ItemBlock, rows: pa.RecordBatch, text_at: int, raw: np.ndarray, offs: np.ndarray
          ) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of the items that the documents of a pass contain."""
    h, at = shingle_hashes(*word_hashes(raw, offs, ALNUM), K)
    shingles: tuple[int, set] = (-1, set())
    for pair in _candidates(block, h, at).tolist():
        d, i = divmod(pair, len(block.ids))
        mine, theirs = block.hashes[i], h[at[d]:at[d + 1]]
        at_most = int((theirs[np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)] == mine).sum())
        if NUM * at_most < DEN * len(block.sets[i]):
            continue
        if shingles[0] != d:
            shingles = (d, exact_shingles(rows.column(text_at)[d].as_py() or ""))
        shared = len(block.sets[i] & shingles[1])
        if NUM * shared >= DEN * len(block.sets[i]):
            yield d, i, shared


def _report(block: ItemBlock, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "n_item", "n_shared"]
    for rows, raw, offs in text_passes(batches):
        out = [(rows.column(0)[d].as_py(), block.ids[i], len(block.sets[i]), n) for d, i, n in _hits(block, rows, 1, raw, offs)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def _clean(block: ItemBlock, text_col: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, offs in text_passes(batches, text_col):
        stays = np.ones(rows.num_rows, bool)
        stays[[d for d, _, _ in _hits(block, rows, rows.schema.get_field_index(text_col), raw, offs)]] = False
        yield rows.filter(pa.array(stays))


def item_blocks(items: DataFrame, item_col: str = "item_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> Iterator[Broadcast]:
    """The items in broadcast blocks of bounded size, one after another."""
    context = items.sparkSession.sparkContext
    items = id_and_text(items, item_col, text_col)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        yield context.broadcast(ItemBlock([(r[0], r[1]) for r in part.collect()]))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item of which 80 % or more of the shingles are in the document."""
    docs = id_and_text(docs, id_col, text_col)
    found = None
    for held in item_blocks(items, item_col, item_text_col, block_bytes):
        hits = docs.mapInArrow(lambda it, held=held: _report(held.value, it), SCHEMA)
        found = hits if found is None else found.unionByName(hits)
    return found


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` less the rows that contain an item, filtered where they lie, block by block."""
    schema = docs.schema
    for held in item_blocks(items, item_col, item_text_col, block_bytes):
        docs = docs.mapInArrow(lambda it, held=held: _clean(held.value, text_col, it), schema)
    return docs
