"""Operator 11 against brute force over several micro-batches, its growth by new files, and its defined cases."""

import itertools
import random
import re

import numpy as np

from minutewise.llm.filter_audit import audit_files, masked_rows, text_masks
from minutewise.llm.common import string_bytes

DOCS = "doc_id long, text string, source string, part string, mask int, batch string"
LABELS = "doc_id long, quality int, toxic int"


def _fails(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {x for x, bad in {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                             "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}.items() if bad}


def _brute(docs, labels):
    first = {}
    for d, t, *_ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    good, toxic = ({d for d, *v in labels if v[i] == 1 and d is not None} for i in (0, 1))
    rows = [((s or ""), _fails(t or "") | ({"E"} if d is not None and d > first[t or ""] else set()), d in good, d in toxic)
            for d, t, s, *_ in docs]
    out = set()
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        steps = {}
        for order in itertools.permutations("ABCDE"):
            left = mine
            for i, x in enumerate(order):
                lost = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                steps["".join(order), i + 1] = (
                    len(left), len(lost), sum(x in f for f, *_ in mine) - len(lost), sum(f == {x} for f, *_ in mine),
                    sum(g for _, g, _ in lost), sum(t for *_, t in lost))
        for (order, i), v in steps.items():
            x = order[i - 1]
            out.add((part, order, i, *v, sum(u[1] for (o, j), u in steps.items() if o[j - 1] == x)))
    return out


def _corpus(seed, n):
    rng = random.Random(seed)
    texts = [None, "", "a", " \t\n", "Éa " * 60] + [
        " ".join(rng.choice(["the", "The", "é#", "SHOUT"] + [f"w{rng.randrange(200)}" for _ in range(20)]) for _ in range(rng.choice([10, 49, 50, 51, 120])))
        for _ in range(25)]
    docs = [(i, rng.choice(texts), rng.choice(["s1", "s2", None, ""]), "x", 1, "b") for i in range(n)]
    docs += [(None, texts[7], "s1", "x", 1, "b"), (None, "", "s2", "x", 1, "b"), (3, docs[3][1], "s2", "x", 1, "b"),
             ((1 << 60) + 1, "big ids", "s1", "x", 1, "b"), ((1 << 60) + 2, "big ids", "s2", "x", 1, "b")]
    labels = [(rng.randrange(n), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)] + [(None, 1, 1)]
    return docs, labels


def _rows(df):
    return {tuple(r[c] for c in ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
            for r in df.collect()}


def test_audit_of_micro_batches_and_of_files_that_come_later(spark, tmp_path):
    docs, labels = _corpus(4, 240)
    ll = spark.createDataFrame(labels, LABELS)
    path = f"{tmp_path}/docs.parquet"
    # the largest ids first, so that most micro-batches retract
    later = sorted(docs, key=lambda d: -(d[0] or 0))
    for lo, hi in ((0, 60), (60, 130)):
        spark.createDataFrame(later[lo:hi], DOCS).coalesce(1).write.mode("append").parquet(path)
    got = audit_files(spark, path, ll, files_per_batch=1, folder=f"{tmp_path}/audit")
    assert _rows(got) == _brute(later[:130], labels)
    spark.createDataFrame(later[130:], DOCS).repartition(3).write.mode("append").parquet(path)
    got = audit_files(spark, path, ll, files_per_batch=1, folder=f"{tmp_path}/audit")
    assert _rows(got) == _brute(docs, labels) == _rows(audit_files(spark, path, ll))
    # nothing new: the same counters
    assert _rows(audit_files(spark, path, ll, folder=f"{tmp_path}/audit")) == _brute(docs, labels)


def test_empty_table_gives_no_rows(spark, tmp_path):
    path = f"{tmp_path}/none.parquet"
    spark.createDataFrame([], DOCS).write.parquet(path)
    assert audit_files(spark, path, spark.createDataFrame([], LABELS)).collect() == []


def test_masks_of_long_texts_are_those_of_whole_ones(spark):
    docs, _ = _corpus(6, 80)
    texts = [d[1] or "" for d in docs] + ["word " * 3000 + "x" * 4000 + " #", "Q" * 9000]
    want = [sum(1 << "ABCD".index(x) for x in _fails(t)) for t in texts]
    for limit in (7, 100, 1 << 20):
        assert [int(text_masks(*(np.array(v) for v in string_bytes(_column([t]))), limit=limit)[0]) for t in texts] == want
    rows = masked_rows(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string"))
    assert [r["mask"] for r in sorted(rows.collect(), key=lambda r: r["doc_id"])] == want


def _column(texts):
    import pyarrow as pa
    return pa.array(texts, pa.string())
