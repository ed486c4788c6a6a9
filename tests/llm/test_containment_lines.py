"""Operators 8 and 10 against brute force, and their defined cases."""

import random
import re

import pytest

from minutewise.llm.containment import ItemBlock, contained_items, exact_shingles, without_contaminated
from minutewise.llm.line_spread import lines_of, remove_spread_lines, spread_lines

DOCS = "doc_id long, text string, source string, extra string"


def _words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def _sets(text):
    w = _words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_containment_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "of", "Éa", "x1", "and"]) if rng.random() < 0.2 else f"w{rng.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 60])))) for i in range(60)]
    items += [(60, None), (61, ""), (0, items[0][1]), (None, "unique item without any id at all here")]
    docs = []
    for d in range(120):
        w = [word() for _ in range(rng.choice([0, 2, 30, 300, 3000]))]
        for _ in range(2):
            _, t = rng.choice(items[:60])
            part = t.split()
            if rng.random() < 0.5 and len(part) > 8:
                part[rng.randrange(len(part))] = "CHANGED"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [p.upper() if rng.random() < 0.1 else p for p in part]
        docs.append((d, " ".join(w) + ".", "s", "e"))
    docs += [(200, None, "s", "e"), (201, "", "s", "e"), (None, "a Unique, item without any id at all here!", "s", "e")]
    want = sorted(((d, i, len(_sets(t)), len(_sets(t) & _sets(x))) for d, x, _, _ in docs for i, t in items
                   if _sets(t) and 5 * len(_sets(t) & _sets(x)) >= 4 * len(_sets(t))), key=str)
    dd = spark.createDataFrame(docs, DOCS)
    ii = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 22, 600):  # one block of items, and several
        got = sorted((tuple(r) for r in contained_items(dd, ii, block_bytes=block).collect()), key=str)
        assert got == want and len(got) > 60
    kept = without_contaminated(dd, ii, block_bytes=600)
    bad = {d for d, *_ in want}
    assert kept.columns == dd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d for d, *_ in docs if d not in bad), key=str)


def test_containment_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    item = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    doc = spark.createDataFrame([(1, "a b c d e f", "s", "e")], DOCS)
    assert contained_items(none, item).count() == 0
    assert contained_items(doc, item.limit(0)).count() == 0
    assert without_contaminated(doc, item.limit(0)).count() == 1


def test_hash_functions_follow_the_smallest_item():
    assert ItemBlock([(1, "one")]).functions > ItemBlock([(1, " ".join(map(str, range(50))))]).functions
    assert exact_shingles("A b") == {(b"a", b"b")}


def _line_oracle(docs, least):
    sites, first = {}, {}
    for d, t, s, _ in docs:
        for x in (t or "").split("\n"):
            x = x.strip(" \t\r\x0b\x0c")
            if x:
                sites.setdefault(x, set()).add(s)
                if d is not None:
                    first[x] = min(first.get(x, d), d)
    out = []
    for d, t, _, _ in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (d is not None and x.strip(" \t\r\x0b\x0c") and
                                         len(sites[x.strip(" \t\r\x0b\x0c")]) >= least and d > first[x.strip(" \t\r\x0b\x0c")])]
        out.append((d, len(lines) if t else 0, len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("near", [0.25, 50.0])
def test_line_spread_equals_brute_force(spark, near):
    """near = 50 sends every line of two sites or more through the exact count."""
    rng = random.Random(7)
    pool = [f"line {i}" for i in range(30)] + ["", "  ", "\t"]
    docs = [(d, "\n".join(rng.choice([" ", ""]) + rng.choice(pool) for _ in range(rng.randrange(0, 9))),
             rng.choice([None, *(f"s{k}" for k in range(14))]), "e") for d in range(150)]
    docs += [(None, "line 1\nline 2", "s1", "e"), (500, None, "s1", "e"), (7, "line 1\nx", "s2", "e"), (7, "line 1\nx", "s2", "e"),
             (501, "line 3\n" * 3000 + "tail", "s3", "e")]
    df = spark.createDataFrame(docs, DOCS)
    for least in (2, 8, 12):
        out = remove_spread_lines(df, min_sites=least, near=near)
        got = sorted(((r["doc_id"], r["_n_lines"], r["_n_removed"], r["text"] or "") for r in out.collect()), key=str)
        assert got == _line_oracle(docs, least)
        assert out.columns[:4] == df.columns


def test_line_spread_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a\nb", "s", "e")], DOCS)
    plan = remove_spread_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert remove_spread_lines(df.limit(0)).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(d, "nine\nten\neleven", f"s{d}", "e") for d in range(9)]
    rows += [(20, "ten\neleven", "s20", "e"), (21, "eleven", "s21", "e")]
    lines = lines_of(spark.createDataFrame(rows, DOCS))
    found = spread_lines(lines, 10).join(lines.select("a", "b").distinct(), ["a", "b"]).count()
    assert found == 2
