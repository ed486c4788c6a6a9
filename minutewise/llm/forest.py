"""Operator 7: embedding near-duplicates by a forest of random-projection trees with spill overlap.

Every node of a tree projects its vectors on a random direction and splits them at the median; vectors whose
projection lies within ``SPILL`` of the median (as a share of the node) go to both sides. The upper levels of each tree
are fitted on a sample of at most ``SAMPLE`` vectors, chosen by a hash of their id; every vector is then routed through
them, and the task that holds a subtree of more than ``LEAF`` vectors goes on splitting them. All pairs within a leaf
are compared by cosine in double precision, and links are united in the leaf, so a leaf emits at most one edge a member.

How many trees a vector needs depends on the depth and on how dense its surroundings are. At each node the projections
give the probability that a partner at the cosine of the threshold goes to the same side (``_partner``); along the
routes of a tree these make the probability that both meet in it. A vector is routed through tree after tree until the
probability that a partner was met in none is at most ``MISS``. Trees are added until this holds for all vectors of
the sample, up to ``TREES``. What is left then, such as vectors of a large dense cluster, is compared exactly: every
vector that did not reach ``MISS`` with every other one, block by block. A partner that reached it was met by its own
account, so no link depends on more trees than there are.

Vectors with equal components form a class that enters the forest once. After the union, links are counted exactly
inside each component by block-wise products of at most ``BLOCK`` by ``BLOCK`` vectors, weighted by class sizes: a link
between two vectors of one component counts whether or not a leaf held both. Neither step emits pairs.

Defined cases: vectors that are null, empty, all zero or hold a null or non-finite component link with nothing; only
vectors of equal length are compared; a row without an id has no component, no links and is kept; repeated rows count
as vectors of their own with the same id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import store
from minutewise.llm.graph import components

#: Trees after which vectors that may still miss a link are compared exactly.
TREES = 12
#: Largest probability of missing a link that a vector leaves the forest with.
MISS = 1e-6
SPILL = 0.07
#: Vectors that a task compares without splitting them further.
LEAF = 4000
#: Vectors of one subtree that a task goes on with, about.
GROUP = 1000
SAMPLE = 1 << 14
BLOCK = 2000
#: Bytes and vectors of a block of those that are compared exactly.
REST_BYTES, REST_BLOCK = 1 << 25, 1 << 14
COSINE = 0.95
_GRID = np.linspace(-8.0, 8.0, 3201)
_NORMAL = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in _GRID])


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, dim and the unit vector's doubles as bytes; null bytes for a vector that can't be compared."""
    for batch in batches:
        lists = batch.column(1)
        units, dims = [], []
        for s in range(0, batch.num_rows, 4096):
            part = lists.slice(s, 4096)
            n = np.where(part.is_valid(), part.value_lengths().fill_null(0), 0).astype(np.int64)
            flat = part.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate([[0], np.cumsum(n)])
            for i in range(len(n)):
                v = values[at[i]:at[i + 1]]
                top = np.abs(v).max() if len(v) else 0.0
                ok = len(v) > 0 and np.isfinite(top) and top > 0
                if ok:
                    v = v / top  # so that squares of very large or small components neither overflow nor vanish
                    v = v / math.sqrt(float(v @ v)) + 0.0
                units.append(v.tobytes() if ok else None)
                dims.append(len(v))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                                         names=["vec_id", "dim", "unit"])


def _matrix(units: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), dim)


def _direction(seed: int, tree: int, node: int, dim: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, node, dim]).standard_normal(dim)


def _split(p: np.ndarray) -> tuple[float, float]:
    lo, hi = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
    return float(lo), float(hi)


def _partner(p: np.ndarray, cut: tuple[float, float, float, float], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities that a partner of vectors with projections ``p`` goes left and that it goes right.

    The gap of two unit vectors' projections has the variance 2 - 2 cosine. Within a node of variance v the partner's
    projection is normal around one that falls back towards the node's mean, as for any two of its members.
    """
    lo, hi, mean, v = cut
    back = max(0.0, 1 - (1 - cosine) / v) if v > 0 else 0.0
    sd = math.sqrt(max(2 - 2 * cosine - (1 - back) ** 2 * v, 1e-12))
    at = mean + back * (p - mean)
    return np.interp((hi - at) / sd, _GRID, _NORMAL), 1 - np.interp((lo - at) / sd, _GRID, _NORMAL)


class Tree:
    """The upper levels of one tree: node (1 is the root, 2i and 2i + 1 the sides of i) -> (lo, hi, mean, variance) of
    its projections. Vectors up to hi go left, vectors from lo go right. ``further`` has the levels that tasks will
    add below a leaf, of ``total`` vectors in all."""

    def __init__(self, sample: np.ndarray, seed: int, number: int, levels: int, total: int = 0):
        self.seed, self.number, self.cuts, self.further = seed, number, {}, {}
        todo = [(1, np.arange(len(sample)), 0)]
        while todo:
            node, rows, level = todo.pop()
            if level == levels or len(rows) < 32:
                size = total * len(rows) / max(1, len(sample))
                self.further[node] = max(0, math.ceil(math.log(max(1, size) / LEAF) / math.log(1 / (0.5 + SPILL))))
                continue
            p = sample[rows] @ _direction(seed, number, node, sample.shape[1])
            lo, hi = _split(p)
            self.cuts[node] = (lo, hi, float(p.mean()), float(p.var()))
            todo += [(2 * node, rows[p <= hi], level + 1), (2 * node + 1, rows[p >= lo], level + 1)]

    def route(self, x: np.ndarray, cosine: float = COSINE) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """(leaf node, rows) over all vectors of ``x``, and the probability that each meets a partner in some leaf."""
        leaves = []

        def visit(node: int, rows: np.ndarray, same: np.ndarray) -> np.ndarray:
            if not len(rows):
                return np.zeros(0)
            if node not in self.cuts:
                leaves.append((node, rows))
                return same ** self.further.get(node, 0)
            cut = self.cuts[node]
            p = x[rows] @ _direction(self.seed, self.number, node, x.shape[1])
            a, b = _partner(p, cut, cosine)
            left, right = p <= cut[1], p >= cut[0]
            # on the next level, of two sides that hold the vector the partner is on one at least
            stay = np.where(left & right, 1.0, np.where(left, a, b))
            met = np.zeros((2, len(rows)))
            met[0, left] = visit(2 * node, rows[left], stay[left])
            met[1, right] = visit(2 * node + 1, rows[right], stay[right])
            both = np.maximum(a + b - 1, 0)
            return (a - both) * met[0] + (b - both) * met[1] + both * (1 - (1 - met[0]) * (1 - met[1]))

        return leaves, visit(1, np.arange(len(x)), np.ones(len(x)))


def _through(trees: list[Tree], x: np.ndarray, cosine: float, missed: np.ndarray | None = None
             ) -> Iterator[tuple[int, int, np.ndarray]]:
    """(tree, leaf node, rows), each vector until it reaches ``MISS``; ``missed`` takes what each is left with."""
    missed = np.ones(len(x)) if missed is None else missed
    for t, tree in enumerate(trees):
        going = np.flatnonzero(missed > MISS)
        leaves, met = tree.route(x[going], cosine)
        missed[going] *= 1 - met
        for node, rows in leaves:
            yield t, node, going[rows]


def forest(sample: np.ndarray, seed: int, levels: int, total: int, trees: int, cosine: float) -> list[Tree]:
    """Trees until every vector of the sample reaches ``MISS``, at most ``trees``."""
    out, missed = [], np.ones(len(sample))
    while len(out) < trees and (missed > MISS).any():
        out.append(Tree(sample, seed, len(out), levels, total))
        going = np.flatnonzero(missed > MISS)
        missed[going] *= 1 - out[-1].route(sample[going], cosine)[1]
    return out


def _linked(x: np.ndarray, comp: np.ndarray, rows: np.ndarray, cosine: float, others: np.ndarray | None = None) -> None:
    """Unite the links among ``rows``, or between them and ``others``, in ``comp`` (local labels), a strip at a time."""
    others = rows if others is None else others
    y = x[others].T
    for s in range(0, len(rows), 512):
        strip = rows[s:s + 512]
        near = x[strip] @ y >= cosine
        for i in np.flatnonzero(near.sum(axis=1) > (others is rows)):
            labels = np.unique(np.append(comp[others[near[i]]], comp[strip[i]]))
            if len(labels) > 1:
                comp[np.isin(comp, labels)] = labels[0]


def _subtree(pdf: pd.DataFrame, seed: int, cosine: float) -> pd.DataFrame:
    """Links of one subtree, united: an edge from each member to the first of its local component."""
    ids, dim = pdf["vec_id"].to_numpy(), int(pdf["dim"].iloc[0])
    x, tree, node = _matrix(pdf["unit"], dim), int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
    comp = np.arange(len(x))
    todo = [(node, comp.copy())]
    while todo:
        node, rows = todo.pop()
        if len(rows) > LEAF:
            p = x[rows] @ _direction(seed, tree, node, dim)
            lo, hi = _split(p)
            left, right = rows[p <= hi], rows[p >= lo]
            if max(len(left), len(right)) < 0.95 * len(rows):
                todo += [(2 * node, left), (2 * node + 1, right)]
                continue
        _linked(x, comp, rows, cosine)
    return _edges(ids, comp)


def _edges(ids: np.ndarray, comp: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame({"a": ids[comp], "b": ids})
    return out[out["a"] != out["b"]]


def _direct(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between two blocks of vectors (or within one), united: an edge from each member to the first."""
    pdf = pdf.sort_values("side", kind="stable")
    ids, x = pdf["vec_id"].to_numpy(), _matrix(pdf["unit"], int(pdf["dim"].iloc[0]))
    comp, cut = np.arange(len(x)), int((pdf["side"] == 0).sum())
    if int(pdf["i"].iloc[0]) == int(pdf["j"].iloc[0]):
        _linked(x, comp, comp.copy(), cosine)
    else:
        _linked(x, comp, np.arange(cut), cosine, np.arange(cut, len(x)))
    return _edges(ids, comp)


def _count(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """For the vectors of one block the weight of their links with another block of the same component."""
    dim = int(pdf["dim"].iloc[0])
    mine, other = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    x, y, w = _matrix(mine["unit"], dim), _matrix(other["unit"], dim), other["copies"].to_numpy(np.float64)
    ids, others = mine["vec_id"].to_numpy(), other["vec_id"].to_numpy()
    total = np.zeros(len(x), np.int64)
    for s in range(0, len(x), 512):
        near = x[s:s + 512] @ y.T >= cosine
        near &= ids[s:s + 512, None] != others[None, :]
        total[s:s + 512] = np.rint(near @ w)
    return pd.DataFrame({"vec_id": ids, "links": total})


def similar_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                    trees: int = TREES, seed: int = 17, sample: int = SAMPLE, group: int = GROUP,
                    rest_block: int = REST_BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``."""
    spark = vectors.sparkSession
    units = store(vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                                 F.col(vector_col).cast("array<double>").alias("v"))
                  .mapInArrow(_unit_rows, "vec_id long, dim int, unit binary"), "op7-units")
    keyed = units.withColumn("k1", F.xxhash64("unit")).withColumn("k2", F.xxhash64(F.lit("second"), "unit"))
    classes = (keyed.where("unit IS NOT NULL AND vec_id IS NOT NULL").groupBy("k1", "k2", "dim")
               .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")))
    classes = store(classes, "op7-classes")

    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n")).limit(64).collect()}
    picked = classes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("dim", "unit").toPandas()
    forests = {}
    for dim, part in picked.groupby("dim"):
        x = _matrix(part["unit"], int(dim))
        levels = max(0, math.ceil(math.log(max(1, sizes.get(dim, 0) / group)) / math.log(1 / (0.5 + SPILL))))
        forests[int(dim)] = forest(x, seed, levels, sizes.get(dim, 0), trees, cosine)
    held = spark.sparkContext.broadcast(forests)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                for t, node, rows in _through(held.value.get(int(dim), []), _matrix(part["unit"], int(dim)), cosine):
                    yield part.iloc[rows].assign(tree=t, node=node)

    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                missed = np.ones(len(part))
                for _ in _through(held.value.get(int(dim), []), _matrix(part["unit"], int(dim)), cosine, missed):
                    pass
                yield part[missed > MISS]

    routed = classes.select("vec_id", "dim", "unit").mapInPandas(route, "vec_id long, dim int, unit binary, tree int, node long")
    edges = routed.groupBy("dim", "tree", "node").applyInPandas(lambda x: _subtree(x, seed, cosine), "a long, b long")
    # also those whose length the sample doesn't hold
    rest = store(classes.select("vec_id", "dim", "unit").mapInPandas(left, "vec_id long, dim int, unit binary"), "op7-rest")
    width = F.least(F.lit(rest_block), F.greatest(F.lit(1), F.floor(F.lit(REST_BYTES) / (8 * F.col("dim")))))
    parts = rest.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", F.ceil(F.col("n") / width).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("vec_id"), "parts").cast("int")
    dealt = (rest.join(parts, "dim").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("dim", "vec_id", "unit", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side")))
    direct = dealt.groupBy("dim", "i", "j").applyInPandas(lambda x: _direct(x, cosine), "a long, b long")
    edges = edges.unionByName(direct)
    found = components(edges)

    member = (classes.join(found.withColumnRenamed("node", "vec_id"), "vec_id")
              .select("root", "vec_id", "dim", "unit", "copies"))
    blocks = found.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = store(member.join(blocks, "root").withColumn("mine", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")),
                "op7-members")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cols = ["root", "dim", "vec_id", "unit", "copies"]
    sides = (own.select(*cols, F.col("mine").alias("i"), every.alias("j"), F.lit(0).alias("side"))
             .unionByName(own.select(*cols, F.col("mine").alias("j"), every.alias("i"), F.lit(1).alias("side"))))
    counted = (sides.groupBy("root", "dim", "i", "j").applyInPandas(lambda x: _count(x, cosine), "vec_id long, links long")
               .groupBy("vec_id").agg(F.sum("links").alias("links")))
    by_class = (classes.select("k1", "k2", "dim", "copies", F.col("vec_id").alias("rep"))
                .join(found.withColumnRenamed("node", "rep"), "rep", "left")
                .join(counted.withColumnRenamed("vec_id", "rep"), "rep", "left")
                .select("k1", "k2", "dim", F.coalesce("root", "rep").alias("root"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    placed = keyed.join(by_class, ["k1", "k2", "dim"], "left")
    ok = F.col("unit").isNotNull() & F.col("vec_id").isNotNull()
    out = placed.select("vec_id", F.when(ok, F.col("links")).otherwise(0).cast("long").alias("n_links"),
                        F.when(ok, F.col("root")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
