"""Operator 6: sampled SentencePiece segmentations without replacement, and their decoding.

A text is a space and then its UTF-8 bytes. Pieces of the vocabulary are the edges of a lattice over these; a
character without a piece is spelt by byte pieces. A piece's log-weight is -ALPHA * log(rank + SHIFT) by its place in
the vocabulary, and a segmentation's probability is the product of its pieces' weights over the sum for all of them.

Segmentations are drawn by Gumbel top-k: each would get its log-probability plus Gumbel noise, and the k largest are
emitted. The noise is never drawn for all of them. An A-star search works on sets of segmentations that share a
prefix and avoid some next pieces: the largest perturbed score of a set is a Gumbel variable around the set's log
mass, truncated at the score of the set that it was split from, which is an exact bound. The best set is split at
the segmentation that attains its bound, drawn piece by piece from backward sums over the lattice; what is left of the
set falls into one set for each later piece. The bound of the best set after the k-th segmentation is the threshold
that gives each emitted one its inclusion score, 1 - exp(-exp(log p - threshold)).

No piece holds a space behind another character, so the lattice falls into words; equal words of a pass share one.
Noise is a hash of (seed, row key, draw, byte), so a row's result does not depend on how rows are spread over tasks.
All steps are vector operations over the documents of a pass; documents are not shuffled.

Defined cases: a null or empty text has one segmentation, without pieces; a text with fewer than k segmentations has
all of them, the rest is left out, and inclusion scores are then 1; rows that repeat key and text get equal results;
a null key counts as key 0; an empty table gives an empty result; other columns are ignored, or kept by
``with_tokens``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutewise.llm.common import free_name, id_and_text, text_passes
from minutewise.llm.wordhash import mix, prefix_hash, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
ALPHA, SHIFT = 1.0, 10.0
#: Log-weight of a byte piece.
BYTE_WEIGHT = -14.0
SEED = 20240611
#: Text bytes of a pass: more of them share more words.
PASS_BYTES = 3 << 17
#: Bytes of the words whose lattices are computed at a time.
BLOCK_BYTES = 1 << 16
_U = np.uint64
_FIX = float(1 << 36)


class Vocabulary(NamedTuple):
    """Piece ids with their bytes and weights, and the trie of the pieces: byte b leads from slot s to slot base[s] + b if
    the parent of that slot is s. The root is slot 0."""
    data: np.ndarray     # bytes of all pieces by id
    at: np.ndarray       # n + 1 offsets into data
    weight: np.ndarray   # by id
    first_byte: int      # id of <0x00>
    base: np.ndarray     # by slot
    parent: np.ndarray   # by slot, or -1
    piece: np.ndarray    # by slot: id of the piece that ends there, or -1
    longest: int


def _trie(whole: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, parent and piece of the slots. The children of a beginning share its base; large families choose first."""
    families: dict[bytes, list[int]] = {b"": []}
    for begin in sorted({p[:k] for p in whole for k in range(1, len(p) + 1)}):
        families[begin] = []
        families[begin[:-1]].append(begin[-1])
    # a window of 256 slots is left only if it or the next one holds a child, so this is room enough
    taken = np.zeros(512 * len(families) + 1024, bool)
    bases, at = {b: 0 for b in families}, 256
    for begin in sorted((b for b in families if len(families[b]) > 1), key=lambda b: (-len(families[b]), b)):
        sons = np.array(families[begin])
        while True:
            slot = at + np.flatnonzero(~taken[at:at + 256])
            slot = slot[~taken[slot[:, None] + (sons[1:] - sons[0])].any(axis=1)]
            if len(slot):
                break
            at += 256
        bases[begin] = int(slot[0] - sons[0])
        taken[bases[begin] + sons] = True
    # the gaps are for the only children
    ones = [b for b in families if len(families[b]) == 1]
    slot = 256 + np.flatnonzero(~taken[256:at + 512 + len(ones)])
    bases.update((b, int(i) - families[b][0]) for b, i in zip(ones, slot))
    size = 1 + max(bases[b] + sons[-1] for b, sons in families.items() if sons)
    # behind the last slot there are 256 more without a parent, to which all lead that have no children
    base, parent, piece = np.full(size + 256, size, np.int64), np.full(size + 256, -1, np.int32), np.full(size + 256, -1, np.int32)
    for begin, sons in families.items():
        slot = bases[begin[:-1]] + begin[-1] if begin else 0
        if sons:
            base[slot] = bases[begin]
        for b in sons:
            parent[bases[begin] + b] = slot
    for p, i in whole.items():
        piece[bases[p[:-1]] + p[-1]] = i
    return base, parent, piece


def load_vocabulary(model_file: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    data, weight, whole = [], np.full(n, -np.inf), {}
    first_byte = -1
    for i in range(n):
        text, score = sp.id_to_piece(i), sp.get_score(i)
        if sp.is_byte(i):
            value = int(text[1:-1], 16)
            first_byte = i - value
            data.append(bytes([value]))
            weight[i] = BYTE_WEIGHT
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            data.append(b"")
        else:
            data.append(text.replace("▁", " ").encode())
            if score > -1e8:  # others are not formed by merging
                weight[i] = -ALPHA * np.log(max(0.0, -score) + SHIFT)
                whole[data[-1]] = i
    return Vocabulary(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]), weight,
                      first_byte, *_trie(whole), max(map(len, whole)))


class Lattice(NamedTuple):
    """Edges sorted by start node; ``upto`` is the cumulated probability of the node's edges up to this one."""
    piece: np.ndarray
    step: np.ndarray     # bytes of the piece
    next: np.ndarray     # the first edge of the node it leads to, or -1 at the end of the word
    q: np.ndarray
    logq: np.ndarray
    upto: np.ndarray
    first: np.ndarray    # by node that has edges: its first edge (and one more entry)
    start: np.ndarray    # by word: the first edge of its first node


def lattice(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, v: Vocabulary) -> Lattice:
    """Lattice of the words raw[starts:ends], long words first, with probabilities of the next piece at each node.

    Words don't depend on each other, so they are taken in blocks of ``BLOCK_BYTES`` whose arrays stay in the processor's
    cache. The steps of a block are as many as its longest word has bytes."""
    upto = np.cumsum(ends - starts)
    cuts = np.flatnonzero(np.diff(upto // BLOCK_BYTES)) + 1
    blocks, edges = [], 0
    for a, b in zip([0, *cuts], [*cuts, len(starts)]):
        blocks.append(_lattice_block(raw, starts[a:b], ends[a:b], v, edges))
        edges += len(blocks[-1].piece)
    net = Lattice(*map(np.concatenate, zip(*blocks)))
    return net._replace(first=np.append(net.first, edges))


def _lattice_block(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, v: Vocabulary, edges: int) -> Lattice:
    """Lattice of a block of words whose first edge has the number ``edges``."""
    n, size = len(starts), ends - starts + 1
    base = np.concatenate([[0], np.cumsum(size)])
    m, final = base[-1], base[1:] - 1
    # behind each word a byte that no piece holds
    flat = np.take(raw, np.repeat(starts - base[:-1], size) + np.arange(m), mode="clip") if n else np.zeros(0, np.uint8)
    flat[final] = 0xFF
    left = np.repeat(final, size) - np.arange(m)
    # nodes by bytes left, and of these by word: the words with so many bytes or more are the first ones
    level = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=1))])
    node = np.take(level, left) + np.repeat(np.arange(n), size)
    byte = np.empty(m, np.int64)
    byte[node] = np.arange(m)
    lead = (flat & 0xC0) != 0x80
    leads = np.flatnonzero(lead)
    own = np.zeros(m, np.int64)
    own[leads] = np.diff(leads, append=m)
    widest = own.max(initial=0)
    single = np.zeros(m, bool)
    single[final] = True
    at = byte[n:]
    at = at[lead[at]]
    slot = np.zeros(len(at), np.int64)
    found = []
    for width in range(1, v.longest + 1):
        to = np.take(v.base, slot) + np.take(flat, at + (width - 1))
        ok = np.flatnonzero(np.take(v.parent, to) == slot)
        if not len(ok):
            break
        at, slot = np.take(at, ok), np.take(to, ok)
        p = np.take(v.piece, slot)
        got = np.flatnonzero(p >= 0)
        here = np.take(at, got)
        found.append((np.take(node, here), np.take(node, here + width), width, np.take(p, got)))
        if width <= widest:
            single[here[np.take(own, here) == width]] = True
    # characters that no piece covers by itself are spelt in bytes
    char = np.maximum.accumulate(np.where(lead, np.arange(m), 0))
    spelt = np.flatnonzero(~single[char])
    found.insert(0, (node[spelt], node[spelt + 1], 1, v.first_byte + flat[spelt].astype(np.int32)))
    count = np.bincount(np.concatenate([x[0] for x in found]), minlength=m)
    first = np.concatenate([[0], np.cumsum(count)])
    free = first[:-1].copy()
    piece, step, to = (np.empty(first[-1], kind) for kind in (np.int32, np.int32, np.int64))
    for from_, into, width, p in reversed(found):  # of a node the long pieces, mostly the likely ones, first
        i = np.take(free, from_)
        piece[i], step[i], to[i] = p, width, into
        free[from_] = i + 1
    total = np.take(v.weight, piece)
    back = np.zeros(m)
    has = np.flatnonzero(count)
    run, width = np.take(first, has), np.take(count, has)
    cuts = np.searchsorted(has, level[1:])
    for i, j in zip(cuts[:-1], cuts[1:]):
        if i == j:
            continue
        begin, stop = run[i], run[j - 1] + width[j - 1]
        total[begin:stop] += np.take(back, to[begin:stop])
        inner = run[i:j] - begin
        top = np.maximum.reduceat(total[begin:stop], inner)
        x = total[begin:stop] - np.repeat(top, width[i:j])
        back[has[i:j]] = top + np.log(np.add.reduceat(np.exp(x, out=x), inner))
    logq = np.subtract(total, np.repeat(back, count), out=total)
    q = np.exp(logq)
    # in fixed point, so that sums don't depend on what else the pass holds
    sums = np.concatenate([[0], np.cumsum(np.rint(q * _FIX).astype(np.int64))])
    upto = np.minimum((sums[1:] - np.repeat(np.take(sums, run), width)) / _FIX, 1.0)
    upto[run + width - 1] = 1.0
    follow = np.where(to < n, -1, np.take(first, to) + edges)
    return Lattice(piece, step, follow, q, np.rint(logq * _FIX).astype(np.int64), upto, run + edges, np.take(first, node[base[:-1]]) + edges)


def _choose(net: Lattice, first: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The edge at the point u < 1 of the cumulated probabilities of each node, given by its first edge."""
    open_ = np.flatnonzero(u >= np.take(net.upto, first))
    out, now, u = first.copy(), np.take(first, open_), np.take(u, open_)
    while len(open_):
        now += 1
        out[open_] = now
        go = np.flatnonzero(u >= np.take(net.upto, now))
        open_, now, u = (np.take(x, go) for x in (open_, now, u))
    return out


def _salted(key: np.ndarray, draw: int) -> np.ndarray:
    return mix(key ^ _U(0xC2B2AE3D27D4EB4F * (draw + 1) & (1 << 64) - 1))


def _uniform(salted: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashed uniform numbers in (0, 1)."""
    h = mix(salted ^ at.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return ((h >> _U(12)).astype(np.float64) + 0.5) / (1 << 52)


def _below(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables around ``mass``, truncated at ``bound``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        out = mass - np.log(np.exp(mass - bound) - np.log(u))
    return np.minimum(out, bound)


class Path(NamedTuple):
    """One segmentation of each document: its tokens in order, and the set that each token splits off."""
    at: np.ndarray       # byte in the pass
    edge: np.ndarray
    gap: np.ndarray      # perturbed bound of the set that leaves the path at this token
    begin: np.ndarray    # by document: its first token (and one more entry)
    fork: np.ndarray     # by document: the token at which the path left another one (-1: none)
    out: np.ndarray      # by document: the edges that the set at the fork avoids, padded with -1


class Drawn(NamedTuple):
    """The r-th segmentation of the documents of a pass."""
    doc: np.ndarray
    piece: np.ndarray
    begin: np.ndarray    # by document: its first token (and one more entry)
    there: np.ndarray    # by document: whether it has so many
    logp: np.ndarray
    score: np.ndarray


def _distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct word, long words first, and the word of each occurrence."""
    hashes = span_hashes(prefix_hash(raw), starts, ends)
    order = np.argsort(hashes)
    hashes = np.take(hashes, order)
    new = np.append(True, hashes[1:] != hashes[:-1])[:len(order)]
    some = order[new]
    size = (ends - starts)[some]
    shorter = size.max(initial=0) - size
    by_size = np.argsort(shorter.astype(np.uint16) if shorter.max(initial=0) < 1 << 16 else shorter, kind="stable")
    place = np.empty_like(by_size)
    place[by_size] = np.arange(len(by_size))
    word = np.empty_like(order)
    word[order] = np.take(place, np.cumsum(new) - 1)
    return some[by_size], word


def draw(raw: np.ndarray, offs: np.ndarray, keys: np.ndarray, v: Vocabulary, k: int = SAMPLES
         ) -> tuple[list[Drawn], np.ndarray]:
    """k segmentations of each document (its bytes with the space in front) and the inclusion threshold of each."""
    n = len(offs) - 1
    key = mix(keys.astype(np.uint64) ^ _U(SEED))
    space = raw == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offs[:-1][np.diff(offs) > 0]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(raw))
    words = np.diff(np.searchsorted(starts, offs))
    doc_of = np.repeat(np.arange(n), words)
    some, word = _distinct(raw, starts, ends)
    net = lattice(raw, starts[some], ends[some], v)
    start = np.take(net.start, word)

    def walk(doc, at, edge, number, path):
        """Draw pieces from each node, given by its first edge, to the end of its word; they go into ``path`` by byte."""
        salted, from_ = np.take(_salted(key, 2 * number), doc), np.take(offs, doc)
        while len(at):
            e = _choose(net, edge, _uniform(salted, at - from_))
            path[at] = e
            edge = np.take(net.next, e)
            go = np.flatnonzero(edge >= 0)
            at, edge, salted, from_ = (np.take(x, go) for x in (at + np.take(net.step, e), edge, salted, from_))

    def finish(path, bound, fork_at, out, number) -> tuple[Path, np.ndarray]:
        """The tokens of ``path`` and the bounds of the sets that leave it at or behind the fork."""
        at = np.flatnonzero(path >= 0)
        edge = np.take(path, at).astype(np.int64)
        begin = np.searchsorted(at, offs)
        size = np.diff(begin)
        sums = np.concatenate([[0], np.cumsum(np.take(net.logq, edge))])
        new = np.flatnonzero(at >= np.repeat(fork_at, size)) if number else np.arange(len(at))
        rest = np.maximum(1 - np.take(net.q, np.take(edge, new)), 0.0)
        fork = np.full(n, -1, np.int64)
        d = np.flatnonzero((fork_at >= 0) & (size > 0))
        if len(d):
            here = np.searchsorted(at, fork_at[d])
            fork[d] = here
            avoid = out[d]
            q = np.where(avoid >= 0, net.q[np.maximum(avoid, 0)], 0.0).sum(axis=1)
            node = np.searchsorted(net.first, edge[here], "right") - 1
            full = (avoid >= 0).sum(axis=1) >= net.first[node + 1] - net.first[node]
            rest[np.searchsorted(new, here)] = np.where(full, 0.0, np.maximum(1 - q, 0.0))
        # nothing is left where a node has one edge only
        some = np.flatnonzero(rest > 0)
        new, rest = np.take(new, some), np.take(rest, some)
        size = np.diff(np.searchsorted(new, begin))
        mass = (np.take(sums, new) - np.repeat(sums[begin[:-1]], size)) / _FIX + np.log(rest)
        u = _uniform(np.repeat(_salted(key, 2 * number + 1), size), np.take(at, new) - np.repeat(offs[:-1], size))
        gap = np.full(len(at), -np.inf)
        gap[new] = _below(mass, np.repeat(bound, size), u)
        return Path(at, edge, gap, begin, fork, out), (sums[begin[1:]] - sums[begin[:-1]]) / _FIX

    def drawn_from(p, there, logp, score):
        return Drawn(np.repeat(np.arange(n), np.diff(p.begin)), np.take(net.piece, p.edge), p.begin, there, logp, score)

    kind = np.int32 if len(net.piece) < 1 << 31 else np.int64
    tokens = np.full(len(raw), -1, kind)
    walk(doc_of, starts, start, 0, tokens)
    best = -np.log(-np.log(_uniform(_salted(key, 1 << 20), np.zeros(n))))
    none = np.full((n, k + 1), -1, np.int64)
    path, logp = finish(tokens, best, np.full(n, -1, np.int64), none, 0)
    paths, drawn = [path], [drawn_from(path, np.ones(n, bool), logp, best)]
    for r in range(1, k + 1):
        top = np.full((len(paths), n), -np.inf)
        for i, p in enumerate(paths):
            has = np.flatnonzero(np.diff(p.begin))
            if len(has):
                top[i, has] = np.maximum.reduceat(p.gap, p.begin[has])
        bound, which = top.max(axis=0), top.argmax(axis=0)
        there = bound > -np.inf
        if r == k:
            return drawn, bound
        fork_at = np.full(n, 1 << 62, np.int64)
        out, go_on = np.full((n, k + 1), -1, np.int64), []
        after = np.full(n, 1 << 62, np.int64)
        tokens = np.full(len(raw), -1, kind)
        for i, p in enumerate(paths):
            mine = there & (which == i)
            hit = np.flatnonzero(p.gap == np.repeat(np.where(mine, bound, np.nan), np.diff(p.begin)))
            d, one = np.unique(np.searchsorted(p.begin, hit, "right") - 1, return_index=True)
            hit = hit[one]
            p.gap[hit] = -np.inf
            at = p.at[hit]
            fork_at[d] = at
            avoid = np.where((p.fork[d] == hit)[:, None], p.out[d], -1)
            fresh = p.fork[d] != hit
            avoid[fresh, 0] = p.edge[hit[fresh]]
            before = hit - p.begin[d]
            keep = np.repeat(hit - np.cumsum(before), before) + np.arange(before.sum())
            tokens[np.take(p.at, keep)] = np.take(p.edge, keep)
            # the next piece at the fork: any but those avoided
            node = np.searchsorted(net.first, p.edge[hit], "right") - 1
            lo = np.where(avoid >= 0, net.upto[np.maximum(avoid, 0)] - net.q[np.maximum(avoid, 0)], 2.0)
            q = np.where(avoid >= 0, net.q[np.maximum(avoid, 0)], 0.0)
            u = _uniform(_salted(key, 2 * r)[d], at - offs[d]) * np.maximum(1 - q.sum(axis=1), 0.0)
            for col in np.argsort(lo, axis=1).T:
                row = np.arange(len(d))
                u = np.where(u >= lo[row, col], u + q[row, col], u)
            e = np.where(u < 1, _choose(net, net.first[node], np.minimum(u, np.nextafter(1.0, 0.0))), net.first[node + 1] - 1)
            for j in np.flatnonzero((avoid == e[:, None]).any(axis=1)):  # rounding
                free = [x for x in range(net.first[node[j]], net.first[node[j] + 1]) if x not in avoid[j]]
                e[j] = max(free, key=lambda x: net.q[x])
            avoid[np.arange(len(d)), (avoid >= 0).sum(axis=1)] = e
            out[d] = avoid
            tokens[at] = e
            after[d] = np.searchsorted(starts, at, "right") - 1
            inside = np.flatnonzero(net.next[e] >= 0)
            go_on.append([d[inside], (at + net.step[e])[inside], net.next[e[inside]]])
        later = np.flatnonzero(np.arange(len(starts)) > np.repeat(after, words))
        go_on.append([doc_of[later], starts[later], start[later]])
        walk(*(np.concatenate(x) for x in zip(*go_on)), r, tokens)
        path, logp = finish(tokens, bound, fork_at, out, r)
        paths.append(path)
        drawn.append(drawn_from(path, there, logp, bound))
    raise AssertionError("k must be positive")


def decode(pieces: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The bytes that pieces stand for, the leading space included."""
    begin = np.take(v.at, pieces)
    size = np.take(v.at, pieces + 1) - begin
    upto = np.cumsum(size)
    from_ = np.repeat(begin - (upto - size), size)
    from_ += np.arange(len(from_))
    return np.take(v.data, from_)


def decode_text(pieces: list[int], v: Vocabulary) -> str:
    return decode(np.asarray(pieces, np.int64), v).tobytes()[1:].decode("utf-8", "replace")


def _spaced(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space in front of every document that isn't empty."""
    full = np.diff(offs) > 0
    to = np.concatenate([[0], np.cumsum(np.diff(offs) + full)])
    out = np.full(to[-1], 0x20, np.uint8)
    row = np.repeat(np.arange(len(full)), np.diff(offs))
    out[np.arange(len(raw)) + np.cumsum(full)[row]] = raw
    return out, to


_DIGEST = 0x100000001B3


def _digests(begin: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each document's pieces in order."""
    size = np.diff(begin)
    place = np.arange(len(piece)) - np.repeat(begin[:-1], size)
    places = mix(np.arange(1, size.max(initial=0) + 1, dtype=np.uint64))
    h = mix(piece.astype(np.uint64) * _U(_DIGEST) + np.take(places, place))
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=sums[1:])
    return (sums[begin[1:]] - sums[begin[:-1]]).view(np.int64)


def _rows(batch: pa.RecordBatch, raw: np.ndarray, offs: np.ndarray, v: Vocabulary, k: int, key_at: int):
    """(whether there, number of tokens, log p, inclusion, digest, round trip, pieces) of the documents of a pass."""
    raw, offs = _spaced(raw, offs)
    keys = batch.column(key_at).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    drawn, bound = draw(raw, offs, keys, v, k)
    n = len(offs) - 1
    there = np.stack([d.there for d in drawn], axis=1)
    count = np.stack([np.diff(d.begin) for d in drawn], axis=1)
    logp = np.stack([d.logp for d in drawn], axis=1)
    with np.errstate(over="ignore"):
        inclusion = -np.expm1(-np.exp(logp - bound[:, None]))
    digest = np.stack([_digests(d.begin, d.piece) for d in drawn], axis=1)
    same = np.ones(n, bool)
    want = np.diff(offs)
    for d in drawn:
        text = decode(d.piece, v)
        size = np.diff(np.concatenate([[0], np.cumsum(np.take(np.diff(v.at), d.piece))])[d.begin])
        ok = d.there & (size == want)
        # all documents of the right size are compared, whatever the others are
        mine, given = (text, raw) if ok.all() else (text[np.repeat(ok, size)], raw[np.repeat(ok, want)])
        if not np.array_equal(mine, given):
            ok[np.repeat(np.flatnonzero(ok), want[ok])[mine != given]] = False
        same &= ok | ~d.there
    # the pieces of all draws of a document one after another
    ends = np.cumsum(count.ravel())
    at = (ends - count.ravel()).reshape(count.shape)
    pieces = np.empty(ends[-1] if len(ends) else 0, np.int32)
    for r, d in enumerate(drawn):
        before = np.cumsum(count[:, r]) - count[:, r]
        pieces[np.repeat(at[:, r] - before, count[:, r]) + np.arange(len(d.piece))] = d.piece
    return there, count, logp, inclusion, digest, same, pieces


def _ragged(values: np.ndarray, there: np.ndarray, kind: pa.DataType) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values[there], kind))


def _piece_lists(pieces: np.ndarray, count: np.ndarray, there: np.ndarray) -> pa.Array:
    """The pieces of each draw that there is (a draw that is not has none)."""
    ends = np.concatenate([[0], np.cumsum(count[there])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pieces))


def segmentations(docs: DataFrame, k: int = SAMPLES, model_file: str = MODEL, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, logp, inclusion, digest (arrays over the draws), round_trip and pieces, the segmentations
    themselves (an array of piece ids for each draw): one row per row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in text_passes(batches, limit=PASS_BYTES):
            there, count, logp, inclusion, digest, same, pieces = _rows(batch, raw, offs, held.value, k, 0)
            lists = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _ragged(count, there, pa.int64()), _ragged(logp, there, pa.float64()),
                 _ragged(inclusion, there, pa.float64()), _ragged(digest, there, pa.int64()), pa.array(same),
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), _piece_lists(pieces, count, there))],
                names=["doc_id", "n_tokens", "logp", "inclusion", "digest", "round_trip", "pieces"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens array<long>, logp array<double>, inclusion array<double>, digest array<long>, "
             "round_trip boolean, pieces array<array<int>>")


def with_tokens(docs: DataFrame, k: int = SAMPLES, model_file: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
                out: str = "tokens") -> DataFrame:
    """``docs`` with ``out``: for each draw its pieces, log-probability and inclusion score. If ``docs`` has a column
    ``out``, the new one gets an underscore before its name (``free_name``)."""
    out = free_name(docs, out)
    held = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))
    key_at = docs.columns.index(id_col)
    draws = T.ArrayType(T.StructType([T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("logp", T.DoubleType()),
                                      T.StructField("inclusion", T.DoubleType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in text_passes(batches, text_col, PASS_BYTES):
            there, count, logp, inclusion, _, _, pieces = _rows(batch, raw, offs, held.value, k, key_at)
            inner = pa.StructArray.from_arrays([_piece_lists(pieces, count, there), pa.array(logp[there]), pa.array(inclusion[there])],
                                               names=["pieces", "logp", "inclusion"])
            rows = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(rows, pa.int32()), inner)],
                                             names=[*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, draws)]))
