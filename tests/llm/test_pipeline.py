"""The corpus pipeline, stage by stage and as a whole."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from minutewise.llm import segment
from minutewise.llm.common import store
from minutewise.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, la, s, len(t) if t is not None else None) for d, t, la, s in rows], DOCS)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(21)
    word = lambda: rng.choice("aeiou") + rng.choice(["n", "st", "ed", "ing", "re"]) + rng.choice(["", "o", "ly", "er"])
    rows, labels = [], []
    for d in range(700):
        w = [word() for _ in range(rng.randrange(12, 60))]
        if toxic := rng.random() < 0.4:
            w[rng.randrange(len(w))] = "blockhead"
        rows.append((d, " ".join(w), "en", f"s{d % 15}"))
        labels.append((d, 1, int(toxic)))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    item = " ".join(f"bench{i}" for i in range(20))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, rows, {d for d, _, t in labels if t}, item


def test_stages_are_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "segmentation"]
    assert P.ORACLE_SQL is None
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_toxic_documents_go_and_clean_ones_stay(spark, tables):
    base, rows, toxic, _ = tables
    docs = _docs(spark, [*rows, (8000, None, None, None), (8001, "", "en", "s1")])
    out = P.toxicity(spark, docs, base)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns
    clean = {d for d, *_ in rows} - toxic
    assert len(toxic - kept) > 0.97 * len(toxic) and len(clean & kept) > 0.97 * len(clean) and {8000, 8001} <= kept


def test_boilerplate_goes_and_the_rest_stays(spark, tables):
    rows = [(d, f"own {d}\nterms of use", "en", f"s{d}") for d in range(12)] + [(50, "terms of use\n\n", "en", "s3"), (51, None, "en", "s1"), (52, "", "en", "s1")]
    got = {r.doc_id: r for r in P.line_dedup(spark, _docs(spark, rows), tables[0]).collect()}
    assert 50 not in got and {51, 52} <= set(got)
    assert got[0].text == "own 0\nterms of use" and got[7].text == "own 7" and got[7].n_chars == 5


def test_one_of_each_group_stays(spark, tables):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = [(10 + i, " ".join(w if j != 5 + i else "x" for j, w in enumerate(base)), "en", "s") for i in range(9)]
    rows += [(30, rows[0][1], "en", "s"), (31, rows[0][1].upper(), "en", "t"), (40, " ".join(rng.sample(base, 80)), "en", "s"),
             (41, "", "en", "s"), (42, "", "en", "s"), (None, rows[0][1], "en", "s")]
    kept = {r.doc_id for r in P.near_dedup(spark, _docs(spark, rows), tables[0]).collect()}
    assert kept == {10, 40, 41, 42, None}


def test_contaminated_documents_go(spark, tables):
    item = tables[3]
    rows = [(1, "some text " + item.upper() + ", more text", "en", "s"), (2, " ".join(item.split()[:9]), "en", "s"), (3, None, "en", "s")]
    docs = _docs(spark, rows)
    out = P.decontamination(spark, docs, tables[0])
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {2, 3}


def test_stage_draws_as_many_segmentations_as_the_operator():
    assert P.DRAWS == segment.SAMPLES


def test_segmentations_decode_to_the_text(spark, tables):
    docs = _docs(spark, [(1, "Some text, with words.", "en", "s"), (2, None, "en", "s"), (3, "", "en", "s")])
    v = segment.load_vocabulary()
    for r in P.segmentation(spark, docs, tables[0]).collect():
        assert 1 <= len(r.tokens) <= P.DRAWS and len({tuple(x.pieces) for x in r.tokens}) == len(r.tokens)
        assert all(segment.decode_text(x.pieces, v) == (r.text or "") for x in r.tokens)


def test_run_over_the_sample_tables(spark):
    sf = "/root/testdata/sf0.001"
    src = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = P.run(spark, sf).collect()
    assert 0 < len(out) < len(src) and len({r.doc_id for r in out}) == len(out)
    for r in out:  # what is left of a text is some of its lines, in order
        lines = iter(src[r.doc_id].split("\n"))
        assert all(any(x == y for y in lines) for x in r.text.split("\n"))


def test_columns_with_clashing_names_are_kept(spark, tables):
    base, rows, toxic, _ = tables
    names = ["tokens", "_kept", "_id", "_gone", "_score", "_threshold", "_toxic", "_n_removed", "_n_lines", "_N_LINES2", "a", "b", "k", "site"]
    plain = _docs(spark, [*rows, (9000, None, None, None)])
    docs = plain.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    want = plain
    for name, stage in P.STAGES:
        docs, want = stage(spark, docs, base), stage(spark, want, base)
        if name != "segmentation":
            assert docs.columns == [*plain.columns, *names], name
            docs, want = store(docs, "clash"), store(want, "plain")
    assert docs.columns == [*plain.columns, *names, "_tokens"] and want.columns == [*plain.columns, "tokens"]
    got, want = ({r["doc_id"]: r for r in df.collect()} for df in (docs, want))
    assert got.keys() == want.keys() and len(got) > 100
    for d, r in got.items():
        assert [r[n] for n in names] == [f"{n}{d}" for n in names]
        assert (r["text"], r["_tokens"]) == (want[d]["text"], want[d]["tokens"])


def test_stages_take_empty_tables_and_nulls(spark, tables):
    base = tables[0]
    docs = _docs(spark, [(None, None, None, None), (1, None, "en", None), (2, "", None, "s"), (None, "some words of a text", "en", "s")])
    for df, n in ((docs, 4), (docs.where("false"), 0)):
        for _, stage in P.STAGES:
            df = store(stage(spark, df, base), "nulls")
        assert df.count() == n
