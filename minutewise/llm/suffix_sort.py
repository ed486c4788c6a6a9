"""Two-stage suffix sorting in numpy.

A suffix smaller than its successor (type B) is sorted directly; one that is larger (type A) is induced: scanning the
bucket of each first symbol in order, the suffix one position before each scanned one takes the next place in its own
bucket. Within a bucket all type A suffixes come before all type B ones, so every place is known when it is scanned.
"""

from __future__ import annotations

import numpy as np

#: Symbols that a direct comparison looks at.
DEPTH = 56


def _rows(sym: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` symbols from each position, zero-padded at the end of ``sym``."""
    padded = np.concatenate([sym, np.zeros(width, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, width)[at]


def two_stage_order(sym: np.ndarray, need: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The suffixes in ``need``, sorted by their first ``depth`` symbols at least.

    ``sym`` holds uint8 symbols and ends in two zeros; zeros separate sequences. ``need`` must hold, with a type A
    suffix, its successor too (``closed`` does that), as the induction passes through it.
    """
    larger, smaller = _types(sym)
    direct = np.flatnonzero(need & smaller)
    keys = np.ascontiguousarray(_rows(sym, direct, depth)).view(f"S{depth}").ravel()
    direct = direct[np.argsort(keys, kind="stable")]
    del keys
    symbols = int(sym.max(initial=0)) + 1
    ends = np.cumsum(np.bincount(sym[direct], minlength=symbols))
    waiting: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    out = []

    def induce(scanned: np.ndarray, own: int) -> np.ndarray:
        """Deal the predecessors out to their buckets; those in the bucket being scanned are returned."""
        before = scanned[scanned > 0] - 1
        before = before[need[before] & larger[before]]
        first = sym[before]
        mine = before[first == own]
        before, first = before[first != own], first[first != own]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(before, cuts) if len(before) else []:
            waiting[int(sym[part[0]])].append(part)
        return mine

    for c in range(symbols):
        wave = np.concatenate([np.zeros(0, np.int64), *waiting[c]])
        while len(wave):
            out.append(wave)
            wave = induce(wave, c)
        part = direct[ends[c] - (ends[c] - (ends[c - 1] if c else 0)):ends[c]]
        out.append(part)
        induce(part, c)
    return np.concatenate([np.zeros(0, np.int64), *out])


def _types(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are larger, and which smaller, than their successors; the last one counts as smaller."""
    n = len(sym)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(sym[:-1].astype(np.int16) - sym[1:])
    step[-1] = -1
    decides = np.where(step != 0, np.arange(n), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    larger = step[decides] > 0
    return larger, ~larger


def closed(sym: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``wanted`` and all suffixes that the induction of its type A members passes through."""
    larger, _ = _types(sym)
    idx = np.arange(len(sym))
    last = np.maximum.accumulate(np.where(wanted, idx, -1))
    stop = np.where(larger, -1, idx)  # a chain from a wanted suffix runs to the next type B one, inclusive
    stop = np.maximum.accumulate(np.concatenate([[-1], stop[:-1]]))
    return wanted | ((last >= 0) & (stop < last))


def common_prefixes(sym: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, up to ``limit`` symbols (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    for s in range(1, len(order), 1 << 17):
        here = order[s:s + (1 << 17)]
        same = _rows(sym, here, limit) == _rows(sym, order[s - 1:s - 1 + len(here)], limit)
        out[s:s + len(here)] = np.where(same.all(axis=1), limit, same.argmin(axis=1))
    return out
