"""Operator 9: masked pseudo-likelihood of documents under a bidirectional window network trained in numpy.

Tokens are words (runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased), told apart by 64-bit
hashes. All words of all documents are counted, so the vocabulary grows with the corpus. For each token the network
sees the ``SIDE`` words on either side, never the token itself, and gives a fit s between them and every word: the
product of a vector of the neighbourhood and a vector of the word. With q the word's share of the corpus,

    P(word | neighbours) = q e^s / (q e^s + mean of e^s over words drawn from the corpus),

and a document's score is the sum of the logarithms of these probabilities. ``NORM`` drawn words, the same for all
tokens, stand for the vocabulary in the mean.

A word's vector is the sum of two rows of a table, chosen by different bits of its hash. The table has as many rows as
the vocabulary has words, up to ``ROWS``; beyond that words share rows, but rarely both. It is trained by a softmax
over the word and words drawn at random, on every document, in two rounds: each task goes over its own documents, from
common weights, and each row is then averaged over the tasks by the number of tokens that moved it. The first round
takes one document of ``FIRST``, by a hash, in tasks of about ``WARM`` documents and ``WARM_BYTES``; the second, from
its weights, takes all others. Up to ``WARM`` documents are gone over in both rounds.

Words are drawn by the counts of the whole vocabulary. The counts of at most ``FREQUENT`` words, the most frequent ones,
are sent to the tasks; counts of the other words stay a table, and the tokens that need them are joined to it. The driver
gets those counts, the drawn words, the weights (all bounded) and a histogram of counts.

Defined cases: a null or empty text has no tokens, the sum 0 and no mean; beyond the ends of a text the network sees
a vector of its own; repeated rows each count and each get a row; rows without an id are scored alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import id_and_text, store, text_passes
from minutewise.llm.wordhash import ALNUM, word_hashes

SIDE = 2
HIDDEN = 16
#: Rows of the tables of word vectors, at most.
ROWS = 1 << 15
#: Words whose counts are sent to the tasks, at most.
FREQUENT = 1 << 18
#: Distinct words that a task counts before it hands them on.
COUNTED = 1 << 20
#: The first round takes a document of so many, and its tasks about so many documents and bytes.
FIRST, WARM, WARM_BYTES = 8, 2000, 16 << 20
#: Words drawn from all tokens (about so many), for a training step and for the mean of a score.
POOL, NOISE, NORM = 1 << 15, 32, 128
BATCH = 4096
RATE = 0.1
SEED = 29
_SHIFTS = tuple(j for j in range(-SIDE, SIDE + 1) if j)
_KEPT = [f"w{k}" for k in range(HIDDEN)]


class Network(NamedTuple):
    """``near``: rows of words as neighbours, the last one beyond the ends of a text. ``word``: as the token itself.
    ``place``: weights of the places of neighbours. ``bias``: of the neighbourhood's vector, in one row."""
    near: np.ndarray
    word: np.ndarray
    place: np.ndarray
    bias: np.ndarray


class Language(NamedTuple):
    """Frequent words in order and their counts, the number of tokens, and words drawn from the corpus."""
    words: np.ndarray
    counts: np.ndarray
    total: int
    pool: np.ndarray


def start_network(rows: int, seed: int = SEED) -> Network:
    rng = np.random.default_rng(seed)
    return Network(*[(at + sd * rng.standard_normal((n, HIDDEN))).astype(np.float32)
                     for n, at, sd in ((rows + 1, 0, 0.2), (rows, 0, 0.05), (len(_SHIFTS), 0.5, 0.1), (1, 0, 0))])


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the n + 1 word offsets of the documents."""
    return word_hashes(raw, offs, ALNUM)


def rows_of(words: np.ndarray, rows: int) -> np.ndarray:
    """(2, words): the rows that make up each word's vector. ``rows`` is a power of two."""
    low = np.uint64(rows - 1)
    return np.stack([words & low, (words >> np.uint64(32)) & low]).astype(np.uint16 if rows < 1 << 16 else np.int64)


def padded(rows: np.ndarray, at: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with ``SIDE`` places of the row beyond the ends around each document, and each token's place."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = np.arange(rows.shape[1]) + SIDE * (doc + 1)
    out = np.full((2, rows.shape[1] + SIDE * len(at)), n_rows, rows.dtype)
    out[:, place] = rows
    return out, place


def _neighbourhood(net: Network, ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the padded words ``ids`` and of the neighbourhoods of the tokens at ``place``. All places that have
    ``SIDE`` others on either side are reckoned, by slices; those between documents are left out at the end."""
    u = np.take(net.near, ids[0], axis=0)
    u += np.take(net.near, ids[1], axis=0)
    x = np.repeat(net.bias, len(u) - 2 * SIDE, axis=0)
    for j, c in zip(_SHIFTS, net.place):
        x += c * u[SIDE + j:len(u) - SIDE + j]
    x = np.take(x, place - SIDE, axis=0)
    return u, np.tanh(x, out=x)


def _word_vectors(net: Network, rows: np.ndarray) -> np.ndarray:
    out = np.take(net.word, rows[0], axis=0)
    out += np.take(net.word, rows[1], axis=0)
    return out


def _sums(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, their sums of ``values`` and numbers of appearances, for (2, n) rows."""
    flat = ids.ravel()
    order = np.argsort(flat, kind="stable")
    seen = flat[order]
    cut = np.concatenate([[0], np.flatnonzero(seen[1:] != seen[:-1]) + 1])
    order -= ids.shape[1] * (order >= ids.shape[1])
    return seen[cut], np.add.reduceat(np.take(values, order, axis=0), cut, axis=0), np.diff(np.append(cut, len(flat)))


def gradients(net: Network, ids: np.ndarray, place: np.ndarray, noise: np.ndarray) -> tuple[float, list]:
    """Summed loss of the tokens at ``place`` among the padded rows ``ids`` against the rows ``noise``, and for each
    table of the network (rows, gradients, appearances)."""
    u, x = _neighbourhood(net, ids, place)
    own = ids[:, place]
    o, drawn = _word_vectors(net, own), _word_vectors(net, noise)
    z = np.concatenate([np.einsum("nh,nh->n", x, o)[:, None], x @ drawn.T], axis=1)
    z -= z.max(axis=1, keepdims=True)
    first = z[:, 0].copy()
    np.exp(z, out=z)
    whole = z.sum(axis=1)
    loss = float((np.log(whole) - first).sum())
    z /= whole[:, None]
    z[:, 0] -= 1
    dx = z[:, :1] * o + z[:, 1:] @ drawn
    dx *= 1 - x * x
    du = np.zeros_like(u)
    dplace = np.empty_like(net.place)
    dall = np.zeros_like(u[2 * SIDE:])
    dall[place - SIDE] = dx
    for k, j in enumerate(_SHIFTS):
        near = slice(SIDE + j, len(u) - SIDE + j)
        dplace[k] = np.einsum("nh,nh->h", dall, u[near])
        du[near] += net.place[k] * dall
    dword = np.concatenate([z[:, :1] * x, z[:, 1:].T @ x])
    n = len(place)
    return loss, [_sums(ids, du), _sums(np.concatenate([own, noise], axis=1), dword),
                  (np.arange(len(_SHIFTS)), dplace / n, n), (np.zeros(1, int), dx.sum(axis=0, keepdims=True) / n, n)]


class Trainer:
    """Adagrad on batches of tokens, on the rows that each batch moves."""

    def __init__(self, net: Network, pool: np.ndarray):
        self.net = Network(*[x.copy() for x in net])
        self.seen = [np.full_like(x, 0.1) for x in net]
        self.moved = [np.zeros(len(x), np.int64) for x in net]
        self.rows = len(net.word)
        self.pool = rows_of(pool, self.rows)
        self.rng = np.random.default_rng(SEED)

    def run(self, words: np.ndarray, at: np.ndarray) -> float:
        """Train on the documents once; their summed loss on the way."""
        ids, place = padded(rows_of(words, self.rows), at, self.rows)
        loss = 0.0
        for s in range(0, len(place), BATCH):
            p = place[s:s + BATCH]
            lo = p[0] - SIDE
            noise = self.pool[:, self.rng.integers(0, self.pool.shape[1], NOISE)]
            more, moves = gradients(self.net, ids[:, lo:p[-1] + SIDE + 1], p - lo, noise)
            loss += more
            for w, seen, moved, (rows, d, n) in zip(self.net, self.seen, self.moved, moves):
                rows = rows.astype(np.intp)
                square = np.take(seen, rows, axis=0)
                square += d * d
                seen[rows] = square
                d *= w.dtype.type(RATE)
                d /= np.sqrt(square, out=square)
                w[rows] = np.take(w, rows, axis=0) - d
                moved[rows] += n
        return loss


def fits(net: Network, lang: Language, words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each token the logarithm of P / (1 - P) without q: s less the logarithm of the mean of e^s."""
    rows = len(net.word)
    ids, place = padded(rows_of(words, rows), at, rows)
    drawn = _word_vectors(net, rows_of(lang.pool[:NORM], rows))
    out = np.zeros(len(place))
    for s in range(0, len(place), BATCH):
        p = place[s:s + BATCH]
        lo = p[0] - SIDE
        part = ids[:, lo:p[-1] + SIDE + 1]
        _, x = _neighbourhood(net, part, p - lo)
        z = x @ drawn.T
        top = z.max(axis=1)
        z -= top[:, None]
        mean = np.exp(z, out=z).mean(axis=1)
        out[s:s + BATCH] = np.einsum("nh,nh->n", x, _word_vectors(net, part[:, p - lo])) - top - np.log(mean)
    return out


def frequent_counts(lang: Language, words: np.ndarray) -> np.ndarray:
    """Counts of the words, 0 where a word is not among the frequent ones."""
    if not len(lang.words):
        return np.zeros(len(words), np.int64)
    i = np.minimum(np.searchsorted(lang.words, words), len(lang.words) - 1)
    return np.where(lang.words[i] == words, lang.counts[i], 0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(words, n):
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])
    words, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _, raw, offs in text_passes(batches):
        more, m = np.unique(tokens(raw, offs)[0], return_counts=True)
        words, back = np.unique(np.concatenate([words, more]), return_inverse=True)
        n = np.bincount(back, np.concatenate([n, m]), len(words)).astype(np.int64)
        if len(words) >= COUNTED:
            yield rows(words, n)
            words, n = words[:0], n[:0]
    if len(words):
        yield rows(words, n)


def _size(n: Column) -> Column:
    """Size class of a count: eight to each doubling."""
    return F.floor(F.log2(n) * 8)


def count_words(docs: DataFrame) -> tuple[DataFrame, int, int, int]:
    """(word, n) of all words, their number, the number of tokens, and the smallest size class such that the words of
    it and of those above are ``FREQUENT`` at most."""
    counts = store(docs.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    sizes = counts.groupBy(_size(F.col("n")).alias("size")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()
    held, least = 0, 1 << 20
    for r in sorted(sizes, key=lambda r: -r["size"]):
        held += r["words"]
        if held > FREQUENT:
            break
        least = r["size"]
    return counts, sum(r["words"] for r in sizes), sum(r["n"] for r in sizes), least


def draw_words(counts: DataFrame, total: int) -> np.ndarray:
    """About ``POOL`` words drawn by their counts: each its expected number of times, rounded by a hash of the word."""
    point = F.pmod(F.xxhash64("word", F.lit(SEED)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    times = F.floor(F.col("n") * F.lit(POOL / total) + point)
    got = counts.select("word", times.alias("times")).where("times > 0").toArrow()
    words, times = (got.column(k).to_numpy() for k in range(2))
    order = np.argsort(words)
    return np.random.default_rng(SEED).permutation(np.repeat(words[order], times[order])).view(np.uint64)


def train_round(docs: DataFrame, common: Network, pool: np.ndarray) -> Network:
    """Each task's weights after its own documents, from ``common``, averaged row by row by the tokens that moved it."""
    held = docs.sparkSession.sparkContext.broadcast((common, pool))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Trainer(*held.value)
        for _, raw, offs in text_passes(batches):
            t.run(*tokens(raw, offs))
        moved = np.concatenate(t.moved)
        rows = np.flatnonzero(moved)
        w = np.concatenate(t.net)[rows].astype(np.float64) * moved[rows, None]
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(moved[rows]), *(pa.array(w[:, k]) for k in range(HIDDEN))],
                                             names=["row", "n", *_KEPT])

    schema = "row long, n long, " + ", ".join(f"{c} double" for c in _KEPT)
    mean = (docs.select("text").mapInArrow(share, schema).groupBy("row")
            .agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in _KEPT]).toArrow())
    net = np.concatenate(common)
    net[mean.column("row").to_numpy()] = np.stack([mean.column(c).to_numpy() for c in _KEPT], axis=1)
    return Network(*np.split(net, np.cumsum([len(x) for x in common])[:-1]))


def rounds(docs: DataFrame, warm: int = WARM) -> list[DataFrame]:
    """The documents of each round of training: all of them together, each in one round (in both if they are ``warm`` at
    most). The first round's tasks take their documents in the order of a hash."""
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    part = min(1.0, max(1 / FIRST, warm / max(1, n)))
    h = F.xxhash64("doc_id", "text")
    early = F.lit(True) if part == 1 else h < F.lit(int(part * (1 << 64)) - (1 << 63))
    tasks = int(max(1, np.ceil(n * part / warm), np.ceil(size * part / WARM_BYTES)))
    first = docs.where(early).select(h.alias("h"), "text").repartition(tasks, "h").sortWithinPartitions("h", "text")
    return [first.select("text"), docs if part == 1 else docs.where(~early)]


def train(docs: DataFrame, warm: int = WARM) -> tuple[DataFrame, int, Language, Network]:
    """Counts of all words, the smallest frequent size class, and the model, from all rows of (doc_id, text)."""
    counts, n_words, total, least = count_words(docs)
    top = counts.where(_size(F.col("n")) >= least).toArrow()
    words, n = (top.column(k).to_numpy() for k in range(2))
    order = np.argsort(words.view(np.uint64))
    pool = draw_words(counts, total) if total else np.zeros(0, np.uint64)
    lang = Language(words[order].view(np.uint64), n[order], total, pool)
    net = start_network(min(ROWS, 1 << max(6, (max(1, n_words) - 1).bit_length())))
    for part in rounds(docs, warm) if total else ():
        net = train_round(part, net, pool)
    return counts, least, lang, net


def log_probabilities(fit: np.ndarray, n: np.ndarray, total: int) -> np.ndarray:
    """Log-probability of each token from its fit and its word's count."""
    odds = np.log(n / total) + fit
    return odds - np.logaddexp(0.0, odds)


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", warm: int = WARM) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log_likelihood: one row per row of ``docs``."""
    docs = id_and_text(docs, id_col, text_col)
    counts, least, lang, net = train(docs, warm)
    held = docs.sparkSession.sparkContext.broadcast((lang, net))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, net = held.value
        for batch, raw, offs in text_passes(batches):
            words, at = tokens(raw, offs)
            fit = fits(net, lang, words, at)
            n = frequent_counts(lang, words)
            known = n > 0
            p = np.zeros(len(words))
            p[known] = log_probabilities(fit[known], n[known], lang.total)
            sums = np.concatenate([[0.0], np.cumsum(p)])
            rare = np.concatenate([[0], np.cumsum(~known)])[at].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(rare), pa.array(x)) for x in (words[~known].view(np.int64), fit[~known])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array(sums[at[1:]] - sums[at[:-1]]),
                                              *lists], names=["doc_id", "n_tokens", "known", "word", "fit"])

    scored = docs.mapInArrow(score, "doc_id long, n_tokens long, known double, word array<long>, fit array<double>")
    # numbered in the stored table, so that a task that runs again finds the same numbers
    base = store(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    open_ = (base.select("row", F.explode(F.arrays_zip("word", "fit")).alias("t"))
             .select("row", F.col("t.word").alias("word"), F.col("t.fit").alias("fit")))
    odds = F.log(F.col("n") / F.lit(lang.total)) + F.col("fit")
    log_p = -F.when(odds > 0, F.log1p(F.exp(-odds))).otherwise(F.log1p(F.exp(odds)) - odds)
    rest = (open_.join(counts.where(_size(F.col("n")) < least).hint("merge"), "word").groupBy("row").agg(F.sum(log_p).alias("rest")))
    whole = F.col("known") + F.coalesce("rest", F.lit(0.0))
    return (base.select("row", "doc_id", "n_tokens", "known").join(rest.hint("merge"), "row", "left")
            .select("doc_id", "n_tokens", whole.alias("log_likelihood"),
                    F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens")).alias("mean_log_likelihood")))
