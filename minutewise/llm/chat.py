"""Operator 12: chat formatting of conversations with typed content parts.

A turn's content is a text, or a JSON list of typed parts: text, image, audio and document, a document with parts of
its own. A visitor walks the parts in order and flattens them: texts are escaped, attachments become placeholders, and
for each attachment its reference, its place in the formatted turn and the number of tokens that it expands to are
recorded. The template puts markers around each turn by role; the loss mask covers the texts of assistant turns.

Escaping. No formatted text holds a marker that the template did not write: a backslash is doubled, and behind the
first character of each marker that stands in a text comes a backslash and a bar. Both are undone by one pass, so
every text, role and reference reads back exactly. A marker has its opening bracket in front only and ends at its
only closing one, and the template puts a blank or a marker on both sides of each text, so none arises at a seam.

A turn is formatted by itself, in the map tasks; a conversation's turns are put in order by one shuffle, and what
needs the whole conversation (offsets, digests) is a running value over its sorted rows, in memory that does not grow
with the conversation. A digest of a sequence can't be split: the turns of a conversation pass through one task, one
after another, at the speed of SHA-256.

Defined cases: a null text or content is empty; a null role is an empty one; turns go by ``turn``, nulls first, ties
by role and formatted text, so repeated rows are repeated turns; rows without a conv_id are one conversation without
an id; content that is no JSON list of typed parts, and a part that is none of the four types, is taken as text, whole;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What opens and closes the turns of the named roles; any other role is written out between its two markers.
ROLES = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>")}
OTHER = ("[ROLE] ", " [AS] ", " [/ROLE]")
LOSS_ROLE = "assistant"
#: Placeholders of attachments; a document with parts of its own is written between the last two.
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
OPEN_DOCUMENT, CLOSE_DOCUMENT = "<pages>", "</pages>"
#: Marker that begins a training sequence: not written here, but no text may hold it either.
BEGIN = "<s>"
#: Pixels of an image patch, tokens a second of audio, tokens a page of a document without parts; one at least.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256

MARKERS = sorted({m.strip() for pair in ROLES.values() for m in pair} | {m.strip() for m in OTHER} | set(PLACEHOLDERS.values())
                 | {OPEN_DOCUMENT, CLOSE_DOCUMENT, BEGIN})
_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in MARKERS))
_UNESCAPE = re.compile(r"\\(\\|\|)")
_TURN = re.compile("|".join(
    [f"{re.escape(a)}(?P<{role}>.*){re.escape(b)}" for role, (a, b) in ROLES.items()]
    + [f"{re.escape(OTHER[0])}(?P<role>.*?){re.escape(OTHER[1])}(?P<other>.*){re.escape(OTHER[2])}"]), re.S)

_SEGMENT = ("conv_id long, turn long, role string, segment string, n_chars long, loss array<struct<start:int,end:int>>, "
            "attachments array<struct<kind:string,ref:string,at:int,tokens:long>>, expanded_tokens long")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\\" if m[1] == "\\" else "", text)


_END = object()


@dataclass
class Attachment:
    kind: str
    ref: str
    at: int
    tokens: int


@dataclass
class Flattener:
    """Visitor of content parts: gathers the formatted text, the spans of plain text in it, and the attachments."""

    out: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[Attachment] = field(default_factory=list)
    #: Text that is not written yet: texts side by side are escaped as one, so no marker arises between them.
    pending: list[str] = field(default_factory=list)
    #: What is still to be visited, the next one last: parts, and ends of documents.
    ahead: list = field(default_factory=list)

    def walk(self, parts: list) -> None:
        self.ahead = list(reversed(parts))
        while self.ahead:
            part = self.ahead.pop()
            if part is _END:
                self.write(CLOSE_DOCUMENT)
            else:
                self.visit(part)

    def write(self, s: str) -> int:
        if self.pending:
            text = escape("".join(self.pending))
            self.pending = []
            if text:
                self.spans.append((self.size, self.size + len(text)))
            self.out.append(text)
            self.size += len(text)
        at = self.size
        self.out.append(s)
        self.size += len(s)
        return at

    def visit(self, part) -> None:
        kind = part.get("type") if isinstance(part, dict) else None
        visit = getattr(self, f"visit_{kind}", None) if kind in ("text", "image", "audio", "document") else None
        if visit is None:
            self.text(part if isinstance(part, str) else json.dumps(part, ensure_ascii=False))
        else:
            visit(part)

    def text(self, text: str) -> None:
        self.pending.append(_encodable(text))

    def visit_text(self, part: dict) -> None:
        text = part.get("text")
        self.text("" if text is None else str(text))

    def visit_image(self, part: dict) -> None:
        wide, high = _number(part.get("width")), _number(part.get("height"))
        self.attach("image", part, math.ceil(wide / PATCH) * math.ceil(high / PATCH))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil(_number(part.get("seconds")) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        inner = part.get("parts")
        if not isinstance(inner, list):
            self.attach("document", part, math.ceil(_number(part.get("pages")) * PAGE_TOKENS))
            return
        self.attach("document", part, 1)
        self.write(OPEN_DOCUMENT)
        self.ahead.append(_END)
        self.ahead += reversed(inner)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        ref = part.get("ref")
        self.attachments.append(Attachment(kind, "" if ref is None else _encodable(str(ref)), self.write(PLACEHOLDERS[kind]), max(1, tokens)))


def _number(x) -> float:
    """A size in an attachment; what is no number, or beyond any size, counts as not given."""
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) and 0 < x < 1 << 31 else 0.0


def _encodable(s: str) -> str:
    """Half a surrogate pair, which JSON can spell, becomes a question mark."""
    return s.encode("utf-8", "replace").decode("utf-8")


def content_parts(content: str, typed: bool) -> list:
    """The parts of a turn's content; plain text is one text part."""
    if typed:
        try:
            parts = json.loads(content)
        except (ValueError, RecursionError):
            parts = None
        if isinstance(parts, list) and all(isinstance(p, dict) and "type" in p for p in parts):
            return parts
    return [{"type": "text", "text": content}]


@dataclass
class Turn:
    segment: str
    loss: list[tuple[int, int]]
    attachments: list[Attachment]


def format_turn(role: str, content: str, typed: bool = False) -> Turn:
    """A turn between the markers of its role, the spans under the loss mask, and its attachments."""
    f = Flattener()
    if role in ROLES:
        before, after = ROLES[role]
        f.write(before)
    else:
        after = OTHER[2]
        f.write(OTHER[0] + escape(role) + OTHER[1])
    f.walk(content_parts(content, typed))
    f.write(after)
    return Turn("".join(f.out), f.spans if role == LOSS_ROLE else [], f.attachments)


def read_turn(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders stay in the text."""
    m = _TURN.fullmatch(segment)
    if m is None:
        raise ValueError("not a formatted turn")
    role = m.lastgroup if m["other"] is None else unescape(m["role"])
    return role, unescape(m["other"] if m["other"] is not None else m[m.lastgroup])


def _formatted(batches: Iterator[pa.RecordBatch], typed: bool) -> Iterator[pa.RecordBatch]:
    types = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                       ("segment", pa.string()), ("n_chars", pa.int64()),
                       ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                       ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()),
                                                           ("tokens", pa.int64())]))),
                       ("expanded_tokens", pa.int64())])
    for batch in batches:
        turns = [format_turn(r, t, typed) for r, t in zip(batch.column("role").to_pylist(), batch.column("content").to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column("conv_id"), batch.column("turn"), batch.column("role"),
            pa.array([t.segment for t in turns], pa.string()),
            pa.array([len(t.segment) for t in turns], pa.int64()),
            pa.array([[{"start": a, "end": b} for a, b in t.loss] for t in turns], types.field("loss").type),
            pa.array([[vars(a) for a in t.attachments] for t in turns], types.field("attachments").type),
            pa.array([sum(a.tokens for a in t.attachments) for t in turns], pa.int64())], schema=types)


def formatted_turns(conversations: DataFrame, typed: bool = False, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", content_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, segment (the formatted turn; a conversation is its segments one after another),
    n_chars, loss (spans of the segment), attachments (their places in the segment, tokens), expanded_tokens.

    ``typed``: the content may be a JSON list of parts; otherwise it is plain text, whatever it looks like.
    """
    role, content = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, content_col))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                role.alias("role"), content.alias("content"))
    return rows.mapInArrow(lambda it: _formatted(it, typed), _SEGMENT)


def in_order(turns: DataFrame) -> DataFrame:
    """Formatted turns, each conversation's together and in order, within the partitions."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")


def with_offsets(turns: DataFrame) -> DataFrame:
    """Formatted turns with ``start``, the place of the segment in its conversation, and ``attachment``, the number of
    attachments before it: running sums, no conversation is gathered."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "segment").rowsBetween(Window.unboundedPreceding, -1)
    return (turns.withColumn("start", F.coalesce(F.sum("n_chars").over(w), F.lit(0)))
            .withColumn("attachment", F.coalesce(F.sum(F.size("attachments")).over(w), F.lit(0))))


class _Reader:
    """What is read back from the segments of one conversation, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars, self.tokens, self.attached = conv_id, 0, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss: list[dict], tokens: int, attached: int) -> None:
        role, text = read_turn(segment)
        self.turns.update(f"{role}\n{text}\n".encode())
        for span in loss:
            learnt = unescape(segment[span["start"]:span["end"]])
            self.loss.update(learnt.encode())
            self.loss_chars += len(learnt)
        self.n_turns += 1
        self.chars += len(segment)
        self.tokens += tokens
        self.attached += attached

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.attached, self.tokens)


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "n_attachments long, expanded_tokens long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation of sorted segments; a conversation may go on over any number of batches."""
    kinds = [pa.string() if k.endswith("string") else pa.int64() for k in _DIGEST.split(", ")]
    names = [k.split()[0] for k in _DIGEST.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    now: _Reader | None = None
    for batch in batches:
        done = []
        for conv_id, segment, loss, tokens, attached in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "segment", "loss", "expanded_tokens", "n_attachments"))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Reader(conv_id)
            now.add(segment, loss, tokens, attached)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([now.row()])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted turns: digests of all turns and of the text under the
    loss mask, sizes, attachments and the tokens that they expand to."""
    ordered = in_order(turns.select("conv_id", "turn", "role", "segment", "loss", "expanded_tokens",
                                    F.size("attachments").cast("long").alias("n_attachments")))
    return ordered.mapInArrow(_digests, _DIGEST)
