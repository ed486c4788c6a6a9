"""Operator 13 against brute force, and its defined cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np

from minutewise.llm.resample import crc_extend, features, importance_scores, resampled

DOCS = "doc_id long, text string, rank string, __drawn string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def _brute(docs, target, share=25, min_words=20, seed=7):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s, t = [0] * 10000, [0] * 10000
    for _, x, *_ in docs:
        for f in _features(x)[1]:
            s[bucket(f)] += 1
    for x in target:
        for f in _features(x)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[i] + 1) * (sum(s) + 10000) / ((s[i] + 1) * (sum(t) + 10000)))) for i in range(10000)]
    rows = []
    for d, x, *_ in docs:
        n, fs = _features(x)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for i, r in enumerate(able[:share * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, rows), key=str)


def _corpus(seed=5, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "of", "Éa", "x1", "naïve", "Í"]) if rng.random() < 0.3 else f"w{rng.randrange(900)}"
    docs = [(i, rng.choice([" ", ", ", "\n", "\x00"]).join(word() for _ in range(rng.choice([0, 1, 19, 20, 21, 60, 400]))), "r", "d")
            for i in range(n)]
    docs += [(n, None, "r", None), (n + 1, "", None, "d"), (n + 2, "x" * 5000 + " y" * 30, "r", "d"), (7, docs[7][1], "r", "d"),
             (None, " ".join(["of"] * 50), "r", "d"), (n + 3, "  ,.;", "r", "d")]
    target = [" ".join(word() for _ in range(30)) for _ in range(20)] + [None, ""]
    return docs, target


def test_scores_and_draw_equal_brute_force(spark):
    docs, target = _corpus()
    dd = spark.createDataFrame(docs, DOCS).repartition(5)
    tt = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in importance_scores(dd, tt).collect()), key=str)
    assert got == _brute(docs, target) and sum(r[5] is not None for r in got) > 20
    drawn = {r[0] for r in got if r[5] is not None}
    kept = resampled(dd, tt)
    assert kept.columns == dd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d[0] for d in docs if d[0] in drawn), key=str)


def test_ties_go_by_doc_id_and_empty_tables(spark):
    one = spark.createDataFrame([(5, "a b"), (5, "a b"), (5, "a b"), (4, "a b")], "doc_id long, text string")
    none = one.where("doc_id < 0").select("text")
    got = importance_scores(one, none, share=50, min_words=2, n=1).collect()
    ranks = [(r["doc_id"], r["rank"]) for r in got if r["rank"] is not None]
    assert sorted(r for _, r in ranks) == [1, 2]
    assert importance_scores(one.where("doc_id < 0"), none).collect() == []
    assert resampled(one.where("doc_id < 0"), none).collect() == []


def test_long_texts_go_in_pieces():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(k)).encode() for k in (3, 500, 0, 40)] + [b"z" * 300 + b" a b " + b"q" * 200 + b" c"]

    def flat(limit, n):
        out = {}
        for first, _, docs, hashed, words in features(texts, 10000, n, limit):
            for d, h in zip(docs.tolist(), hashed.tolist()):
                out.setdefault(first + d, []).append(h)
            for d in words.tolist():
                out.setdefault(("words", first + d), []).append(0)
        return {k: sorted(v) for k, v in out.items()}

    for n in (1, 2, 3):
        whole = flat(1 << 20, n)
        for limit in (10, 64, 300, 1000):
            assert flat(limit, n) == whole


def test_crc_of_long_and_short_words():
    words = [b"", b"a", b"ab" * 20, b"c" * 47, b"d" * 48, b"e" * 49, b"f" * 1000]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    got = crc_extend(np.full(len(words), zlib.crc32(b"x "), np.uint32), b"".join(words), starts, ends)
    assert got.tolist() == [zlib.crc32(b"x " + w) for w in words]
