"""Operators 1, 2 and 7 against brute force, and their defined cases."""

import hashlib
import random

import numpy as np
import pytest

from minutewise.llm import near_minhash as nm
from minutewise.llm.forest import similar_vectors
from minutewise.llm.graph import components
from minutewise.llm.near_minhash import near_duplicates
from minutewise.llm.suffix_repeats import remove_repeats
from minutewise.llm.suffix_sort import closed, common_prefixes, two_stage_order
from minutewise.llm.wordhash import shingle_hashes, word_hashes

DOCS = "doc_id long, text string, extra string"


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def _shingles(text, k):
    w = (text or "").encode().lower().split()
    return set(zip(*(w[j:] for j in range(k)))) if len(w) >= k else ({tuple(w)} if w else set())


def _near_oracle(docs, k, pct):
    sets = {d: _shingles(t, k) for d, t, _ in docs if d is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b])]
    root = _roots(ids, links)
    return sorted(((d, len(_shingles(t, k)), root.get(d), d is None or root[d] == d) for d, t, _ in docs), key=str)


@pytest.mark.parametrize("block", [nm.BLOCK, 4])
def test_near_duplicates_equal_brute_force(spark, block):
    rng = random.Random(11)
    docs, d = [], 0
    for _ in range(12):  # chains of edits: neighbours are near, ends may not be
        w = [f"w{rng.randrange(500)}" for _ in range(rng.choice([4, 40, 120]))]
        for _ in range(rng.choice([1, 2, 9, 14])):
            docs.append((d, " ".join(w), "x"))
            d += 1
            for _ in range(max(1, len(w) // 45)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
    docs += [(d + 1, docs[0][1].upper() + " \n", "x"), (d + 2, None, "x"), (d + 3, "", "x"), (d + 4, "One two", "x"),
             (d + 5, "one\ttwo ", "x"), (d + 6, " ", "x"), (None, docs[3][1], "x"), docs[5], (d + 7, "a " * 5000, "x")]
    rng.shuffle(docs)
    out = near_duplicates(spark.createDataFrame(docs, DOCS), k=3, pct=85, block=block)
    assert sorted((tuple(r) for r in out.collect()), key=str) == _near_oracle(docs, 3, 85)


def test_near_duplicates_defaults_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "x")], DOCS)
    assert {(r["doc_id"], r["kept"]) for r in near_duplicates(df).collect()} == {(1, True), (2, False)}
    assert near_duplicates(df.limit(0)).count() == 0


def test_pairs_at_the_default_threshold_are_not_missed(spark):
    docs = []
    for i in range(0, 5000, 2):  # 40 common words of 50: a similarity of 0.80
        docs += [(i + j, " ".join([f"w{i}_{n}" for n in range(40)] + [f"v{i + j}_{n}" for n in range(5)])) for j in (0, 1)]
    out = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=1)
    assert [r["doc_id"] for r in out.collect() if r["component_id"] != r["doc_id"] - r["doc_id"] % 2] == []


def test_one_bucket_with_several_components(spark):
    """Members that differ from the smallest member but not from each other are united in the second step."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for g in range(4):
        own = [w if rng.random() < 0.93 else f"g{g}_{i}" for i, w in enumerate(base)]
        for c in range(4):
            w = own[:]
            w[c] = f"c{g}{c}"
            docs.append((g * 10 + c, " ".join(w), "x"))
    for rows, bands in ((2, 60), (1, 40)):
        out = near_duplicates(spark.createDataFrame(docs, DOCS), k=1, pct=85, rows=rows, bands=bands, block=3)
        assert sorted((tuple(r) for r in out.collect()), key=str) == _near_oracle(docs, 1, 85)


def test_sketches_estimate_similarity():
    words = [" ".join(f"w{i}" for i in range(s, s + 400)) for s in (0, 40, 200)]
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    offs = np.cumsum([0] + [len(w) + 1 for w in words])
    offs[-1] = len(raw)
    sk = nm.sketches(*shingle_hashes(*word_hashes(raw, offs), 1), t=2400)
    for a, b in ((0, 1), (0, 2), (1, 2)):
        sa, sb = set(words[a].split()), set(words[b].split())
        assert abs((sk[a] == sk[b]).mean() - len(sa & sb) / len(sa | sb)) < 0.05
    short = np.frombuffer(b"one two", np.uint8)
    assert (nm.sketches(*shingle_hashes(*word_hashes(short, np.array([0, 7])), 1)) < nm._M).all()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7)]
    links += [(a, b) for a, b in ((rng.randrange(900, 1100), rng.randrange(900, 1100)) for _ in range(90)) if a != b]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == _roots(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _repeat_oracle(docs):
    first = {}
    for d, t, _ in docs:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - 49):
                s = b[i:i + 50]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t, _ in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - 49):
                if first[b[i:i + 50]] < d:
                    gone[i:i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [1 << 22, 700])
def test_repeats_equal_brute_force(spark, shard):
    rng = random.Random(13)
    noise = lambda n: "".join(rng.choice("abcd é\n\0ß😀") for _ in range(n))
    shared = [noise(n) for n in (30, 49, 50, 51, 60, 90, 130, 400)] + ["x" * 70, "ab" * 60]
    docs = []
    for d in range(90):
        docs.append((d * 3, "".join(rng.choice([noise(rng.randrange(80)), rng.choice(shared)]) for _ in range(rng.randrange(7))), "e"))
    docs += [(1000, docs[8][1], "e"), (1001, docs[8][1], "e"), (1001, docs[8][1], "e"), (1002, None, "e"), (1003, "", "e"),
             (None, shared[-3], "e"), (1004, "y" * 2000, "e"), (1005, "z" + "y" * 3000, "e"), (1006, shared[2], "e"),
             (1007, shared[1], "e"), (2, shared[7] + "q" * 49, "e")]
    rng.shuffle(docs)
    out = remove_repeats(spark.createDataFrame(docs, DOCS), shard_bytes=shard)
    assert sorted((tuple(r) for r in out.collect()), key=str) == _repeat_oracle(docs)


def test_repeats_of_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_two_stage_order_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(150):
        a = rng.integers(1, 4, rng.integers(1, 150)).astype(np.uint8)
        a[rng.random(len(a)) < 0.05] = 0
        sym = np.concatenate([a, np.zeros(2, np.uint8)])
        need = closed(sym, rng.random(len(sym)) < rng.random())
        order = two_stage_order(sym, need, 8)
        assert sorted(order.tolist()) == np.flatnonzero(need).tolist()
        padded = sym.tobytes() + b"\0" * 8
        keys = [padded[i:i + 8] for i in order]
        assert keys == sorted(keys)
        lcp = common_prefixes(sym, order, 8)
        for x, y, n in zip(keys, keys[1:], lcp[1:]):
            assert x[:n] == y[:n] and (n == 8 or x[n] != y[n])


def _vector_oracle(rows, cosine=0.95):
    ok = {}
    for i, (vid, v, _) in enumerate(rows):
        if vid is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            u = u / np.abs(u).max()
            ok[i] = u / np.linalg.norm(u)
    links = [(i, j) for i in ok for j in ok if i < j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine]
    count = {i: 0 for i in range(len(rows))}
    for i, j in links:
        count[i] += 1
        count[j] += 1
    ids = {rows[i][0] for i in range(len(rows)) if rows[i][0] is not None}
    root = _roots(ids, [(rows[i][0], rows[j][0]) for i, j in links])
    return sorted(((vid, count[i], root.get(vid), vid is None or root[vid] == vid) for i, (vid, _, _) in enumerate(rows)), key=str)


def test_similar_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(32)
        for _ in range(int(rng.choice([1, 2, 12, 60]))):
            rows.append((len(rows), [float(x) for x in centre + rng.standard_normal(32) * rng.choice([0.1, 0.25])], "e"))
    n = len(rows)
    rows += [(n + 1, rows[3][1], "e"), (n + 1, rows[3][1], "e"), (n + 2, None, "e"), (n + 3, [], "e"), (n + 4, [0.0] * 32, "e"),
             (n + 5, [None] + [1.0] * 31, "e"), (n + 6, [float("nan")] + [1.0] * 31, "e"), (n + 7, [float("inf")] * 32, "e"),
             (None, rows[0][1], "e"), (n + 8, [1.0, 2.0], "e"), (n + 9, [2.0, 4.0], "e"), (n + 10, [1e300, 2e300], "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, extra string")
    out = similar_vectors(df, group=40)
    assert sorted((tuple(r) for r in out.collect()), key=str) == _vector_oracle(rows)
    assert similar_vectors(df.limit(0)).count() == 0


def test_links_inside_a_dense_cluster_are_all_found(spark):
    rng = np.random.default_rng(6)

    def unit(v):
        return v / np.linalg.norm(v, axis=-1, keepdims=True)

    centre = unit(rng.standard_normal(64))

    def around(v):  # mutual cosine of about 0.9
        return np.sqrt(0.9) * centre + np.sqrt(0.1) * unit(v - np.outer(v @ centre, centre))

    a = unit(rng.standard_normal((400, 64)))
    x = np.vstack([around(rng.standard_normal((2000, 64))), around(a), around(0.55 * a + 0.835 * unit(rng.standard_normal((400, 64)))),
                   unit(rng.standard_normal((600, 64)))])
    near = x @ x.T
    assert np.abs(near - 0.95).min() > 1e-9
    near = (near >= 0.95) & ~np.eye(len(x), dtype=bool)
    links = np.argwhere(np.triu(near)).tolist()
    assert len(links) > 150
    root = _roots(range(len(x)), links)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in similar_vectors(df, group=40, rest_block=700).collect()}
    assert got == {i: (int(near[i].sum()), root[i]) for i in range(len(x))}
