"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes that ``word_bytes`` admits, hashed as a polynomial in an odd base modulo 2^64: prefix sums
give every word of a pass in a few vector operations. Words never cross documents.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_U = np.uint64

#: Bytes of the words `[^\x20\x09-\x0D]+`.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of letters, digits and all non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def ascii_lower_bytes(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser with full avalanche (two multiply-xorshift rounds)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, _BASE_INV, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


#: Bytes of a pass up to which the powers are kept; only a longer document has its own.
_KEPT = 1 << 21
_kept_powers = lru_cache(maxsize=1)(_powers)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n at least."""
    return _kept_powers(_KEPT) if n <= _KEPT else _powers(n)


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] = sum of (byte + 1) * base^position over s <= position < e."""
    up, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + _U(1)) * up[:len(raw)], out=out[1:])
    return out


def word_spans(raw: np.ndarray, offs: np.ndarray, word_bytes: np.ndarray = NON_SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``raw``, and for each document the index of its first word (n + 1 entries)."""
    inside = word_bytes[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offs] = True
    before = np.zeros(len(raw), bool)
    if len(raw):
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(total))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, offs: np.ndarray, word_bytes: np.ndarray = NON_SPACE
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lower-cased, and the n + 1 word offsets of the documents."""
    starts, ends, at = word_spans(raw, offs, word_bytes)
    return span_hashes(prefix_hash(_LOWER[raw]), starts, ends), at


def stem_hashes(raw: np.ndarray, offs: np.ndarray, sizes: tuple[int, ...], word_bytes: np.ndarray = ALNUM
                ) -> tuple[np.ndarray, np.ndarray]:
    """(words, 1 + sizes): hashes of each word and of its first bytes by each of ``sizes``, 0 where it has no more
    bytes than that; and the n + 1 word offsets of the documents."""
    starts, ends, at = word_spans(raw, offs, word_bytes)
    total = prefix_hash(_LOWER[raw])
    cols = [span_hashes(total, starts, ends)]
    for n in sizes:
        cols.append(np.where(ends - starts > n, span_hashes(total, starts, np.minimum(starts + n, ends)) + _U(n), _U(0)))
    return np.stack(cols, axis=1), at


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each document, sorted within it, and the n + 1 offsets.

    A document with 1 to k - 1 words has one shingle, its whole sequence; one without words has none.
    """
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    start = np.repeat(at[:-1], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    width = np.minimum(n, k)[doc]
    h = np.full(len(doc), 0x51ED270B, np.uint64)
    for j in range(k):
        more = j < width
        nxt = mix(h * _U(0xA24BAED4963EE407) + words[np.minimum(start + j, max(len(words) - 1, 0))]) if len(words) else h
        h = np.where(more, nxt, h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[keep], h[keep]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))
