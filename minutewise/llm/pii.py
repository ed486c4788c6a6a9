"""Operator 4: personal data by weak supervision, in DataFrame functions throughout.

Spans come from patterns: the base kinds, which always stay if they pass their check, and further candidate kinds.
Labelers (shape, words around, a gazetteer of host endings, other personal data in the text) vote for, against or not
at all on each candidate. The votes are counted by pattern; expectation-maximisation over these counts (at most
3^labelers rows, whatever the input) estimates how reliable each labeler is and the probability of each pattern.
With these as soft labels, counts by feature train a final naive-Bayes span classifier, which sees what the labelers
don't: the shape of the span and the words next to it. A further candidate stays if the classifier finds it
likelier than not to be personal and it does not overlap a base span.

Positions come from ``split`` and ``regexp_extract_all`` with the same pattern: a span starts where the lengths of the
pieces and matches before it sum up to. Patterns are written with possessive quantifiers and anchored starts, which
give the same matches and keep Java's matcher linear and free of recursion on very long runs.

Defined cases: a null or empty text has no spans; repeated rows and rows without an id each get their own result;
ties do not arise, as spans of a kind do not overlap; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutewise.llm.common import store

# The base kinds in the order of the result.
BASE = ("email", "ip", "card", "phone")
#: Further kinds, added by the method.
MORE = ("contact", "number", "secret")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "contact": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[(\[{{] ?(?:at|AT) ?[)\]}}] ?[A-Za-z0-9-]++"
               r"(?: ?(?:\.|[(\[{] ?(?:dot|DOT) ?[)\]}]) ?[A-Za-z0-9-]++)++",
    "number": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{2,4}[ .-][0-9]{2,4}"
              r"(?:[ .-][0-9]{2,4})*+(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?i:password|passwd|secret|token|api[_-]?key) ?[=:] ?"
              r"[\"']?[A-Za-z0-9+/_-]{8,}+)(?![A-Za-z0-9])",
}
#: A character, or else a pattern, without which a kind can't match.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_NEEDS_PATTERN = {"card": "[0-9]", "contact": r"(?:at|AT) ?[)\]}]", "number": "[0-9]", "secret": "AKIA|[=:]"}
_CONTEXT = 40
# Words that speak for or against personal data next to a span.
_FOR = r"(?i)\b(?:tel|phone|call|fax|mobile|mail|e-?mail|contact|address|card|visa|account|iban|ssn|passport|name|login|user)\b"
_AGAINST = r"(?i)\b(?:version|licen[cs]e|page|chapter|section|isbn|issn|figure|table|price|vol|rfc|lines?)\b"
_ENDINGS = r"(?i)(?:\.|dot ?[)\]}] ?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"
LABELERS = ("shape", "before", "after", "ending", "company", "digits")
ROUNDS = 50
#: Candidates' worth of smoothing in the classifier's counts.
SMOOTH = 4.0
#: Buckets of the words next to a span that the classifier tells apart.
WORD_BUCKETS = 1 << 12


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes Luhn's check."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: Column, match: Column) -> Column:
    """The check of a base kind; other kinds have none."""
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    digits = _digits(match)
    n = F.length(digits)
    return (F.when(kind == "ip", match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
            .when(kind == "card", F.when((n >= 13) & (n <= 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", (n >= 9) & (n <= 15)).otherwise(True))


def _matches(kind: str, text: Column) -> Column:
    """Array of (kind, match, gap to the match before, text before, text after) of a kind."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, PATTERNS[kind], -1)
    rows = F.transform(
        F.filter(F.arrays_zip(found.alias("m"), pieces.alias("p"), F.slice(pieces, 2, 1 << 30).alias("q")),
                 lambda x: x["m"].isNotNull()),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["m"].alias("match"), F.length(x["p"]).cast("long").alias("gap"),
                           F.right(x["p"], F.lit(_CONTEXT)).alias("before"), F.left(x["q"], F.lit(_CONTEXT)).alias("after")))
    needs = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else text.rlike(_NEEDS_PATTERN[kind])
    return F.when(needs, rows).otherwise(F.array().cast(
        "array<struct<kind:string,match:string,gap:bigint,before:string,after:string>>"))


def candidates(rows: DataFrame) -> DataFrame:
    """(rid, kind, start, end, match, before, after, valid); ``rows`` has rid and hits. Matches of a base kind that
    fail its check are never a result, but the labelers and the classifier learn from them."""
    each = rows.select("rid", F.explode("hits").alias("k")).select("rid", F.posexplode("k").alias("i", "s"))
    before = Window.partitionBy("rid", "s.kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (each.select("rid", "i", "s", (F.col("s.gap") + F.length("s.match")).alias("step"))
              .withColumn("end", F.sum("step").over(before))
              .select("rid", "s.kind", (F.col("end") - F.length("s.match")).alias("start"), "end", "s.match", "s.before",
                      "s.after"))
    return placed.withColumn("valid", _passes(F.col("kind"), F.col("match")))


def _votes(c: DataFrame) -> DataFrame:
    """One column of -1, 0 or 1 for each labeler."""
    near = F.substring_index("before", "\n", -1)
    digits = F.length(_digits(F.col("match")))
    base = F.col("kind").isin(*BASE)
    repeated = F.regexp_replace(_digits(F.col("match")), "([0-9])\\1+", "$1")
    per_text = Window.partitionBy("rid")
    good = (base & F.col("valid")).cast("int")
    others = F.sum(good).over(per_text) - good

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    return c.withColumns({
        "shape": vote((base & F.col("valid")) | F.col("kind").isin("contact", "secret") | F.col("match").rlike(r"^\([0-9]{2,5}\)"), ~F.col("valid") | F.col("match").rlike(r"^(?:[0-9]{1,2}[ .-][0-9]{1,2}[ .-]|(?:19|20)[0-9]{2}[ .-])")),
        "before_": vote(near.rlike(_FOR), near.rlike(_AGAINST)),
        "after_": vote(F.col("after").rlike(_FOR), F.col("after").rlike(r"^\s*(?:%|[€$£]|km|kg|GB|MB)")),
        "ending": vote(F.col("match").rlike(_ENDINGS), F.col("kind").isin("email", "contact")),
        "company": vote(others > 0, F.lit(False)),
        "digits": vote((digits >= 9) & (digits <= 16) & (F.length(repeated) * 2 > digits),
                       ((digits > 0) & (digits < 7)) | (F.length(repeated) * 2 <= digits) & (digits > 0))})


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[dict, list[dict], float]:
    """EM over vote patterns and their counts: the probability that each pattern is personal, each labeler's
    probabilities of its votes for either class, and the share of personal candidates."""
    width = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns) or 1
    prior = 0.5
    # start: a labeler that votes is right three times in four
    rel = [{(y, v): {1: 0.45, 0: 0.4, -1: 0.15}[v if y else -v] for y in (0, 1) for v in (-1, 0, 1)} for _ in range(width)]
    post = {}
    for _ in range(rounds):
        for votes, _n in patterns:
            log = [math.log(1 - prior), math.log(prior)]
            for j, v in enumerate(votes):
                for y in (0, 1):
                    log[y] += math.log(rel[j][(y, v)])
            post[votes] = 1 / (1 + math.exp(min(700.0, max(-700.0, log[0] - log[1]))))
        prior = min(0.99, max(0.01, sum(post[v] * n for v, n in patterns) / total))
        for j in range(width):
            for y in (0, 1):
                got = {v: 1.0 + {1: 2.0, 0: 1.0, -1: 0.0}[v if y else -v] for v in (-1, 0, 1)}  # keeps the classes apart
                for votes, n in patterns:
                    got[votes[j]] += n * (post[votes] if y else 1 - post[votes])
                whole = sum(got.values())
                rel[j].update({(y, v): g / whole for v, g in got.items()})
    return post, rel, prior


def _features(match: Column, before: Column, after: Column, kind: Column) -> Column:
    """What the classifier sees of a span: kind, shape, length, and hashed words next to it."""
    shape = F.regexp_replace(F.regexp_replace(F.left(match, F.lit(64)), "[0-9]+", "9"), "[A-Za-z]+", "a")
    word = lambda c, p: F.pmod(F.xxhash64(F.lower(F.regexp_extract(c, p, 1))), F.lit(WORD_BUCKETS)).cast("string")
    return F.array(F.concat(F.lit("k"), kind), F.concat(F.lit("s"), F.pmod(F.xxhash64(shape), F.lit(WORD_BUCKETS)).cast("string")),
                   F.concat(F.lit("n"), F.least(F.length(match), F.lit(64)).cast("string")),
                   F.concat(F.lit("b"), word(before, r"(\w+)\W*$")), F.concat(F.lit("a"), word(after, r"^\W*(\w+)")))


def classified(c: DataFrame) -> DataFrame:
    """``c`` with ``personal``, the final classifier's decision on each candidate."""
    voted = store(_votes(c).withColumn("pattern", F.array("shape", "before_", "after_", "ending", "company", "digits"))
                  .withColumn("features", _features(F.col("match"), F.col("before"), F.col("after"), F.col("kind")))
                  .select("rid", "kind", "start", "end", "valid", "pattern", "features"), "op4-votes")
    counts = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # 3^6 rows at most
    post, _, prior = estimate([(tuple(r["pattern"]), r["n"]) for r in sorted(counts, key=lambda r: r["pattern"])])
    soft = F.lit(0.5)
    if post:
        soft = F.create_map(*[x for v, p in post.items() for x in (F.lit(",".join(map(str, v))), F.lit(p))])[
            F.array_join(F.transform("pattern", lambda v: v.cast("string")), ",")]
    soft_rows = voted.withColumn("p", soft)
    # log-odds of a feature by soft counts, each class smoothed by what both have: at most 3 * WORD_BUCKETS and some more rows
    one = soft_rows.select("p", F.explode("features").alias("f"))
    sums = soft_rows.agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).first()
    yes, no = sums["yes"] or 0.0, sums["no"] or 0.0
    part = SMOOTH * (F.count(F.lit(1)) / max(yes + no, 1.0))
    weights = one.groupBy("f").agg((F.log((F.sum("p") + part) / (yes + SMOOTH))
                                    - F.log((F.sum(1 - F.col("p")) + part) / (no + SMOOTH))).alias("w"))
    more = voted.where(F.col("kind").isin(*MORE)).select("rid", "kind", "start", "end", F.explode("features").alias("f"))
    # one row a feature (the bound above), and only a few features for a kind: no shuffle by feature
    scored = more.join(F.broadcast(weights), "f").groupBy("rid", "kind", "start", "end").agg(F.sum("w").alias("z"))
    base = voted.where(F.col("kind").isin(*BASE) & F.col("valid")).select("rid", "kind", "start", "end", F.lit(True).alias("personal"))
    return base.unionByName(scored.select("rid", "kind", "start", "end", (
        F.col("z") + math.log(prior / (1 - prior)) > 0).alias("personal")))


def _apart(spans: DataFrame) -> DataFrame:
    """The base spans, and the added ones that overlap no base span and no added one that starts before."""
    base = F.col("kind").isin(*BASE)
    order = Window.partitionBy("rid").orderBy("start", F.when(base, 0).otherwise(1), "end", "kind")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    reach = F.coalesce(F.max("end").over(earlier), F.lit(-1))
    nxt = F.coalesce(F.min(F.when(base, F.col("start"))).over(later), F.lit(1 << 62))
    return (spans.withColumn("_ok", base | ((reach <= F.col("start")) & (nxt >= F.col("end")))).where("_ok").drop("_ok"))


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: one row per row of ``docs``."""
    kinds = (*BASE, *MORE)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       text.alias("text"))
    rows = store(rows.select("rid", "doc_id", F.filter(F.array(*[_matches(k, F.col("text")) for k in kinds]),
                                                       lambda x: F.size(x) > 0).alias("hits")), "op4-rows")
    spans = _apart(classified(candidates(rows)).where("personal"))
    number = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    joined = lambda xs: F.array_join(F.transform(F.array_sort(xs), lambda x: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in kinds]), x["k"] + 1), x["a"].cast("string"), x["b"].cast("string"))), ",")
    per_row = spans.groupBy("rid").agg(
        F.collect_list(F.struct(number[F.col("kind")].alias("k"), F.col("start").alias("a"), F.col("end").alias("b"))).alias("all"),
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in BASE])
    out = rows.select("rid", "doc_id").join(per_row, "rid", "left")
    every = F.coalesce(F.col("all"), F.array().cast("array<struct<k:int,a:bigint,b:bigint>>"))
    base = F.filter(every, lambda x: x["k"] < len(BASE))
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
                      F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"),
                      (F.size(every) - F.size(base)).cast("long").alias("n_added"))
