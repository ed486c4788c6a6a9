"""Operator 3: a convolutional text classifier for toxicity, trained in numpy.

Words (runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased) and their first ``STEMS`` bytes are
hashed into ``BUCKETS`` embeddings; a word's vector is the sum of these, so that inflected forms share a stem. Filters of several widths slide over the whole text, each keeps its largest response, and a logistic unit
reads these. Backpropagation touches only the positions that won. The model is fitted on all labelled rows that are not held
out. A fifth of them, by a hash of the id, serves to choose among the rounds, to calibrate the scores and to set a
threshold for each language; the others are learnt from in ``ROUNDS`` rounds. In each, every task goes ``EPOCHS`` times
over its share of them, of about ``SHARE`` documents and ``SHARE_BYTES``, from common weights, and each embedding and
filter is then averaged over the tasks by how often they moved it. The driver gets weights, counts by bucket and counts
by steps of the logit, all bounded. Every document is
then scored where it lies, over its whole text. Labels, language, source and ids are never inputs of a score.

Defined cases: a null or empty text gets the score of padding alone; labels that are null or name no document teach
nothing, and of repeated labels the larger counts; repeated rows each get a row; without labels of both kinds every
score is 0; an empty table gives an empty result; other columns are ignored, or kept by ``flag_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutewise.llm.common import free_name, store, text_passes
from minutewise.llm.wordhash import stem_hashes

#: Labelled documents and bytes that a task learns from, about.
SHARE, SHARE_BYTES = 5000, 16 << 20
BUCKETS = 1 << 17
STEMS = (4, 5, 6)
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Training documents that a word must occur in to have an embedding.
LEAST_DOCS = 4
ROUNDS, EPOCHS, BATCH, RATE = 3, 2, 64, 0.05
#: Logits of the rows kept back are counted in steps of this.
STEP = 1 / 256
THRESHOLD = 0.7
#: Share of right decisions that a language's threshold is set for, and toxic rows it takes to set one.
PRECISION, LEAST_ROWS = 0.98, 20
#: Between these a language's threshold lies.
LEAST_CUT, MOST_CUT = 0.5, 0.9
_PAD = max(WIDTHS)


class Model(NamedTuple):
    emb: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float]
    thresholds: dict[str, float]


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (1 to BUCKETS - 1, 0 for none) of the words and stems of each document, followed by padding (0), and
    the n + 1 offsets."""
    h, at = stem_hashes(raw, offs, STEMS)
    n = np.diff(at)
    start = np.concatenate([[0], np.cumsum(n + _PAD)])
    out = np.zeros((start[-1], 1 + len(STEMS)), np.int32)
    doc = np.repeat(np.arange(len(n)), n)
    out[np.arange(len(h)) + _PAD * doc] = np.where(h == 0, 0, h % np.uint64(BUCKETS - 1) + np.uint64(1))
    return out, start


def _vectors(emb: np.ndarray, tok: np.ndarray) -> np.ndarray:
    x = emb[tok[..., 0]]
    for j in range(1, tok.shape[-1]):
        x = x + emb[tok[..., j]]
    return x


def _pooled(m: Model, tok: np.ndarray, start: np.ndarray, winners: bool = False):
    """The largest response of each filter in each document and, if asked for, where it is."""
    x = _vectors(m.emb, tok)
    size = np.diff(start)
    best, place = [], []
    for w, f in zip(WIDTHS, m.filters):
        r = x @ f[0]
        for j in range(1, w):
            r[:-j] += x[j:] @ f[j]
            r[start[1:] - j] = -np.inf
        top = np.maximum.reduceat(r, start[:-1], axis=0)
        best.append(top)
        if winners:
            hit = r == np.repeat(top, size, axis=0)
            i = np.where(hit, np.arange(len(r))[:, None], len(r))
            place.append(np.minimum.reduceat(i, start[:-1], axis=0))
    return np.concatenate(best, axis=1) + m.bias, place


def _logits(m: Model, tok: np.ndarray, start: np.ndarray) -> np.ndarray:
    if len(start) == 1:
        return np.zeros(0)
    pooled, _ = _pooled(m, tok, start)
    return (np.maximum(pooled, 0) @ m.out + m.out_bias).astype(np.float64)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def scores(m: Model, tok: np.ndarray, start: np.ndarray) -> np.ndarray:
    return _sigmoid(m.scale[0] * _logits(m, tok, start) + m.scale[1])


def _take(tok: np.ndarray, start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = (start[1:] - start[:-1])[rows]
    at = np.concatenate([[0], np.cumsum(size)])
    return tok[np.repeat(start[rows] - at[:-1], size) + np.arange(at[-1])], at


def _learning(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, offsets, labels) of the documents of each pass."""
    for batch, raw, offs in text_passes(batches):
        yield *tokens(raw, offs), batch.column(batch.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False)


def _bucket_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents hold each bucket."""
    seen = np.zeros(BUCKETS, np.int64)
    for t, at, _ in _learning(batches):
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        seen += np.bincount(np.unique((doc[:, None] * BUCKETS + t).ravel()) % BUCKETS, minlength=BUCKETS)
    rows = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(seen[rows])], names=["bucket", "docs"])


def start_model(known: np.ndarray, seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    emb = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
    emb[~known] = 0
    filters = [(rng.standard_normal((w, DIM, FILTERS)) * (0.5 / np.sqrt(w))).astype(np.float32) for w in WIDTHS]
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    return Model(emb, filters, bias, (rng.standard_normal(len(bias)) * 0.3).astype(np.float32), 0.0, (1.0, 0.0), {})


class Trainer:
    """Adagrad on batches of documents, on the embeddings that each batch moves."""

    def __init__(self, m: Model, known: np.ndarray, second: list, seed: int):
        self.m = m._replace(emb=m.emb.copy(), filters=[f.copy() for f in m.filters], bias=m.bias.copy(), out=m.out.copy())
        self.known = known
        self.second, self.last = [x.copy() for x in second[:-1]], second[-1]
        self.moved, self.n = np.zeros(BUCKETS, np.int64), 0
        self.rng = np.random.default_rng(seed)

    def _step(self, v: np.ndarray, g: np.ndarray, s: np.ndarray) -> None:
        s += g * g
        v -= RATE * g / np.sqrt(s)

    def run(self, tok: np.ndarray, start: np.ndarray, y: np.ndarray) -> None:
        """Go over the documents once."""
        m, second = self.m, self.second
        for part in np.array_split(self.rng.permutation(len(y)), max(1, len(y) // BATCH)):
            t, at = _take(tok, start, part)
            pooled, place = _pooled(m, t, at, winners=True)
            act = np.maximum(pooled, 0)
            err = (_sigmoid(act @ m.out + m.out_bias) - y[part]).astype(np.float32) / len(part)
            back = err[:, None] * m.out * (pooled > 0)
            g_out, g_last = act.T @ err, float(err.sum())
            rows, grads = [], []
            for k, (w, f, at_best) in enumerate(zip(WIDTHS, m.filters, place)):
                b = back[:, k * FILTERS:(k + 1) * FILTERS]
                g_f = np.empty_like(f)
                for j in range(w):
                    e = _vectors(m.emb, t[at_best + j])  # documents x filters x DIM
                    g_f[j] = np.einsum("nf,nfd->df", b, e)
                    for own in np.moveaxis(t[at_best + j], -1, 0):
                        rows.append(own.ravel())
                        grads.append((b[:, :, None] * f[j].T[None]).reshape(-1, DIM))
                self._step(f, g_f, second[1 + k])
            rows, grads = np.concatenate(rows), np.concatenate(grads)
            ids, inv = np.unique(rows, return_inverse=True)
            g = np.stack([np.bincount(inv, grads[:, d], len(ids)) for d in range(DIM)], axis=1).astype(np.float32)
            g[ids == 0] = 0
            second[0][ids] += g * g
            m.emb[ids] -= RATE * g / np.sqrt(second[0][ids])
            self.moved[ids] += 1
            self._step(m.bias, back.sum(axis=0), second[-2])
            self._step(m.out, g_out, second[-1])
            self.last += g_last ** 2
            m = m._replace(out_bias=m.out_bias - RATE * g_last / np.sqrt(self.last))
        self.m = m
        self.n += len(y)


#: Embeddings and their sums of squares by bucket; filters, bias and output weights, with theirs, in rows beyond these.
_KEPT = [f"w{k}" for k in range(2 * DIM)]


def _as_rows(m: Model, second: list) -> np.ndarray:
    """All weights and sums of squares, ``DIM`` and ``DIM`` to a row; the embeddings come first."""
    def rest(parts, last):
        flat = np.concatenate([*[x.ravel() for x in parts], [last]]).astype(np.float64)
        return np.append(flat, np.zeros(-len(flat) % DIM)).reshape(-1, DIM)
    return np.concatenate([np.concatenate([m.emb, rest([*m.filters, m.bias, m.out], m.out_bias)]),
                           np.concatenate([second[0], rest(second[1:-1], second[-1])])], axis=1)


def _from_rows(rows: np.ndarray, m: Model) -> tuple[Model, list]:
    def parts(half):
        shapes = [x.shape for x in (*m.filters, m.bias, m.out)]
        cuts = np.cumsum([int(np.prod(x)) for x in shapes])
        flat = half[BUCKETS:].ravel()
        return [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, cuts), shapes)], float(flat[cuts[-1]])
    (*filters, bias, out), last = parts(rows[:, :DIM])
    squares, square = parts(rows[:, DIM:])
    emb, seen = (rows[:BUCKETS, k:k + DIM].astype(np.float32) for k in (0, DIM))
    return m._replace(emb=emb, filters=filters, bias=bias, out=out, out_bias=last), [seen, *squares, square]


def _train_round(rows: DataFrame, m: Model, second: list, known: np.ndarray, number: int) -> tuple[Model, list]:
    """Each task's weights after its rows, from ``m``, averaged: embeddings by the batches that moved them, the others by
    the number of documents."""
    held = rows.sparkSession.sparkContext.broadcast((m, second, known))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, second, known = held.value
        t = Trainer(m, known, second, number)
        parts = list(_learning(batches))  # a share is bounded
        if not parts:
            return
        tok = np.concatenate([p[0] for p in parts])
        tok[~known[tok]] = 0
        start = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])
        y = np.concatenate([p[2] for p in parts]).astype(np.float32)
        parts.clear()
        for _ in range(EPOCHS):
            t.run(tok, start, y)
        w = _as_rows(t.m, [*t.second, t.last])
        n = np.full(len(w), t.n)
        n[:BUCKETS] = t.moved
        got = np.flatnonzero(n)
        w = w[got] * n[got, None]
        yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(n[got]), *(pa.array(w[:, k]) for k in range(2 * DIM))],
                                         names=["row", "n", *_KEPT])

    mean = (rows.mapInArrow(share, "row long, n long, " + ", ".join(f"{c} double" for c in _KEPT)).groupBy("row")
            .agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in _KEPT]).toArrow())
    out = _as_rows(m, second)
    out[mean.column("row").to_numpy()] = np.stack([mean.column(c).to_numpy() for c in _KEPT], axis=1)
    return _from_rows(out, m)


def _counted_logits(rows: DataFrame, m: Model) -> pd.DataFrame:
    """(step, lang, toxic, n): how many rows kept back have a logit of each step."""
    held = rows.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in text_passes(batches):
            z = np.clip(_logits(held.value, *tokens(raw, offs)), -40, 40)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(z / STEP).astype(np.int64)), batch.column(batch.schema.get_field_index("lang")),
                                              batch.column(batch.schema.get_field_index("toxic"))], names=["step", "lang", "toxic"])

    found = rows.mapInArrow(run, "step long, lang string, toxic int")
    # languages with too few toxic rows for a threshold of their own count together
    own = found.groupBy("lang").agg(F.sum("toxic").alias("t")).where((F.col("t") >= LEAST_ROWS) & F.col("lang").isNotNull())
    lang = F.broadcast(own.select("lang", F.col("lang").alias("own")))
    return (found.join(lang, "lang", "left").groupBy("step", F.col("own").alias("lang"), "toxic")
            .agg(F.count(F.lit(1)).alias("n")).toPandas())


def _loss(counted: pd.DataFrame) -> float:
    if not len(counted):
        return 0.0
    p = np.clip(_sigmoid(counted["step"].to_numpy() * STEP), 1e-6, 1 - 1e-6)
    return float(-np.average(np.where(counted["toxic"] == 1, np.log(p), np.log(1 - p)), weights=counted["n"]))


def _calibrated(m: Model, counted: pd.DataFrame) -> Model:
    """Scores scaled by two parameters on the rows kept back, and the threshold of each language on these."""
    if not len(counted):
        return m
    counted = counted.sort_values(["step", "toxic"], ascending=[False, True], kind="stable")
    z, t, n = counted["step"].to_numpy() * STEP, counted["toxic"].to_numpy().astype(float), counted["n"].to_numpy()
    a, b = 1.0, 0.0
    for _ in range(200):  # plain gradient steps on a convex loss, with a pull towards a = 1
        e = _sigmoid(a * z + b) - t
        a -= 0.02 * float(np.average(e * z, weights=n) + 0.01 * (a - 1))
        b -= 0.1 * float(np.average(e, weights=n))
    m, cut = m._replace(scale=(max(a, 0.05), b)), {}
    for one, rows in counted[counted["lang"].notna()].groupby("lang"):
        steps = rows.assign(hit=rows["toxic"] * rows["n"]).groupby("step")[["hit", "n"]].sum().sort_index(ascending=False).cumsum()
        good = np.flatnonzero(steps["hit"] / steps["n"] >= PRECISION)
        if steps["hit"].iloc[-1] >= LEAST_ROWS and len(good):
            # the lower end of the step
            p = _sigmoid(np.array([m.scale[0] * (steps.index[good[-1]] - 0.5) * STEP + m.scale[1]]))[0]
            cut[str(one)] = float(np.clip(p, LEAST_CUT, MOST_CUT))
    return m._replace(thresholds=cut)


def held_out(doc_id):
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          label_col: str = "toxic") -> Model | None:
    """The model, or None without labels of both kinds."""
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    # rows that repeat an id count once; labels grow with the documents: the same shuffle join at every size
    rows = store(texts.join(known.hint("merge"), "id").dropDuplicates(["id"]).withColumn("h", F.xxhash64("id")), "toxicity-labelled")
    check = F.pmod(F.col("h"), F.lit(5)) == 0
    n, size, toxic = rows.where(~check).agg(F.count(F.lit(1)), F.sum(F.octet_length("text")), F.sum("toxic")).first()
    if not n or toxic in (0, n):
        return None
    tasks = int(max(1, np.ceil(n / SHARE), np.ceil(size / SHARE_BYTES)))
    learnt = rows.where(~check).repartition(tasks, "h").sortWithinPartitions("h", "id").select("text", "toxic")
    kept = rows.where(check).select("text", "lang", "toxic")
    seen = np.zeros(BUCKETS, np.int64)
    counts = learnt.mapInArrow(_bucket_docs, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).toArrow()
    seen[counts.column("bucket").to_numpy()] = counts.column("docs").to_numpy()
    common = seen >= LEAST_DOCS
    common[0] = False
    m = start_model(common)
    second = [*[np.full_like(v, 1e-6) for v in (m.emb, *m.filters, m.bias, m.out)], 1e-6]
    best, best_loss, best_counted = m, np.inf, None
    for number in range(ROUNDS):
        m, second = _train_round(learnt, m, second, common, number)
        counted = _counted_logits(kept, m)
        loss = _loss(counted)
        if loss < best_loss or not len(counted):
            best, best_loss, best_counted = m, loss, counted
    return _calibrated(best, best_counted)


def with_scores(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``."""
    if model is None:
        return docs.withColumn(out, F.lit(0.0))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in text_passes(batches, text_col):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(held.value, *tokens(raw, offs)))],
                                             names=[*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def flag_toxic(docs: DataFrame, labels: DataFrame, lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``_score``, the ``_threshold`` of its language (0.7 where none could be set) and ``_toxic``; a name
    that ``docs`` has already is taken with a further underscore (``free_name``)."""
    score, threshold, toxic = (free_name(docs, c) for c in ("_score", "_threshold", "_toxic"))
    model = train(docs, labels, lang_col=lang_col)
    cut = F.lit(THRESHOLD)
    for lang, at in sorted((model.thresholds if model else {}).items()):
        cut = F.when(F.col(lang_col) == lang, at).otherwise(cut)
    out = with_scores(docs, model, out=score).withColumn(threshold, cut)
    return out.withColumn(toxic, F.col(score) >= F.col(threshold))
