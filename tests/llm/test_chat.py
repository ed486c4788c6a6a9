"""Operator 12: exact round trips, typed parts against a plain walk, order, digests and its defined cases."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from minutewise.llm.chat import (MARKERS, conversation_digests, escape, format_turn, formatted_turns, read_turn, unescape,
                                 with_offsets)

ROWS = "conv_id long, turn long, role string, text string, segment string, loss int"
PIECES = st.lists(st.sampled_from([*MARKERS, *(m[:3] for m in MARKERS), *(m[1:] for m in MARKERS), "\\", "|", "\\|", " ", "a", "É", "\n", "[", "<"]),
                  max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES)
def test_escaping_is_reversible_and_leaves_no_marker(text):
    safe = escape(text)
    assert unescape(safe) == text and not any(m in safe for m in MARKERS)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), PIECES), PIECES)
def test_a_turn_reads_back(role, text):
    turn = format_turn(role, text)
    assert read_turn(turn.segment) == (role, text)
    learnt = "".join(unescape(turn.segment[a:b]) for a, b in turn.loss)
    assert learnt == (text if role == "assistant" else "")
    # markers in the formatted turn are the template's own
    assert sum(turn.segment.count(m) for m in MARKERS) == (2 if role in ("user", "assistant", "system") else 3)


def test_what_is_not_a_turn_is_refused():
    with pytest.raises(ValueError):
        read_turn("no marker")


def test_typed_parts_are_flattened_in_order():
    parts = [{"type": "text", "text": "see <ima"}, {"type": "text", "text": "ge> "},
             {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "text", "text": None},
             {"type": "document", "ref": "d.pdf", "parts": [
                 {"type": "text", "text": "page "}, {"type": "audio", "ref": "s.wav", "seconds": 1.5}, "loose",
                 {"type": "document", "ref": "in.pdf", "pages": 2}, {"type": "document", "parts": []}]},
             {"type": "video", "ref": "v"}, {"type": "image"}]
    turn = format_turn("assistant", json.dumps(parts), typed=True)
    assert turn.segment == ('[ANS] see <\\|image> <image><document><pages>page <audio>loose<document><document><pages></pages></pages>'
                            '{"type": "video", "ref": "v"}<image> </s>')
    assert [(a.kind, a.ref, a.tokens) for a in turn.attachments] == [
        ("image", "a.png", 3), ("document", "d.pdf", 1), ("audio", "s.wav", 38), ("document", "in.pdf", 512),
        ("document", "", 1), ("image", "", 1)]
    for a in turn.attachments:
        assert turn.segment[a.at:].startswith(f"<{a.kind}>")
    assert [unescape(turn.segment[a:b]) for a, b in turn.loss] == ["see <image> ", "page ", "loose", '{"type": "video", "ref": "v"}']


def test_content_that_is_no_list_of_parts_is_text():
    for content in ("[1, 2]", "{}", "[", '"x"', "[]", "null", "[" * 100000, '[{"type": "text"}, 3]', ""):
        want = "" if content == "[]" else content
        assert read_turn(format_turn("user", content, typed=True).segment) == ("user", want)
        assert read_turn(format_turn("user", content).segment) == ("user", content)
    deep = {"type": "text", "text": "end"}
    for _ in range(300):
        deep = {"type": "document", "ref": "r", "parts": [deep]}
    assert len(format_turn("user", json.dumps([deep]), typed=True).attachments) == 300
    odd = [{"type": "text", "text": "\ud800"}, {"type": "image", "ref": 7, "width": 1e300, "height": "x"}, {"type": "audio", "seconds": True}]
    turn = format_turn("user", json.dumps(odd), typed=True)
    assert turn.segment == "[INST] ?<image><audio> [/INST]" and [a.tokens for a in turn.attachments] == [1, 1]


def _brute(rows):
    out = {}
    for c, _, role, text, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", escape(r[3] or ""))):
        role, text = role or "", text or ""
        n, turns, loss, size = out.get(c, (0, "", "", 0))
        out[c] = (n + 1, turns + f"{role}\n{text}\n", loss + (text if role == "assistant" else ""), size + len(format_turn(role, text).segment))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return sorted(((c, n, sha(t), len(x), sha(x), size, 0, 0) for c, (n, t, x, size) in out.items()), key=str)


def test_digests_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.choice([1, 2, 3, 4, None]), t, rng.choice(["user", "assistant", "system", "tool [AS]", None]),
             rng.choice([None, "", "</s>[INST] ok [/INST]", "É\\|" * 9, "long " * 4000]), "x", 1) for t in range(120)]
    rows += [rows[5], (1, None, "user", "first", "x", 1), (9, 0, "user", None, None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # conversations go on over batches
    try:
        got = sorted((tuple(r) for r in conversation_digests(formatted_turns(df)).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _brute(rows)


def test_offsets_and_attachments_of_a_conversation(spark):
    image = json.dumps([{"type": "image", "ref": "r"}, {"type": "text", "text": "x"}])
    df = spark.createDataFrame([(1, 0, "user", image), (1, 1, "assistant", "yes"), (1, 2, "user", image), (2, 0, "user", None)],
                               "conv_id long, turn long, role string, text string")
    turns = formatted_turns(df, typed=True)
    rows = sorted(with_offsets(turns).collect(), key=lambda r: (r["conv_id"], r["turn"]))
    whole = "".join(r["segment"] for r in rows if r["conv_id"] == 1)
    for r in rows[:3]:
        assert whole[r["start"]:r["start"] + r["n_chars"]] == r["segment"]
    assert [r["attachment"] for r in rows] == [0, 1, 1, 0]
    digest = {r["conv_id"]: r for r in conversation_digests(turns).collect()}
    assert digest[1]["n_attachments"] == 2 and digest[1]["expanded_tokens"] == 2 and digest[1]["formatted_chars"] == len(whole)


def test_an_empty_table(spark):
    assert conversation_digests(formatted_turns(spark.createDataFrame([], ROWS))).collect() == []
