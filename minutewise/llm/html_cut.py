"""Operator 5: main text of web pages by minimum cut.

A page is cut into blocks of text at block-level tags. A block's classifier (a logistic function of its tags, words of
class and id, length, links and sentence marks) gives the capacities of its edges to the two terminals, content and
boilerplate. Smoothness edges tie blocks that follow one another, and blocks whose nearest containers in the DOM are
the same, more strongly the closer they are. The maximum flow's cut labels the blocks at the least total cost.

Elements that never hold main text (scripts, styles, hidden elements and the like) bind their blocks to boilerplate
with infinite capacity, and so do navigation, asides, forms and other containers of boilerplate, unless they wrap the
page: a form with an article or main element in it is judged by its blocks, as is one that holds half of a page without
such an element; an aside, header, footer, menu or dialog is when all articles of the page lie in such containers. The
classifier's weights are stated, not fitted: the tables hold no blocks with labels.

Pages are independent, so they are labelled where they lie, without a shuffle; a page's graph grows with its blocks,
and reading it takes time in proportion to its length, whatever its tags leave open.

Defined cases: a null or empty page, or one without text, has the text ""; unclosed and crossing tags close their
blocks in page order; the end tag of an inline element closes no block; a quote opens an attribute's value only after
its equals sign, and one that is never closed is part of the value; `br` is white space; equal blocks are judged each
by itself; repeated rows each get a row; rows without an id keep a null id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's elements by their role here.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li main menu nav noscript ol optgroup
option p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("""script style noscript head title button select option textarea label legend iframe template svg math
object canvas audio video xmp noembed noframes""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements at whose start an open paragraph ends.
ENDS_PARAGRAPH = HEADINGS | frozenset("""address article aside blockquote center details dialog div dl fieldset figcaption
figure footer form header main menu nav ol p pre section table ul""".split())
#: Containers of boilerplate, unless they wrap the page's article.
WRAPPERS = frozenset("nav footer header aside form menu dialog".split())
_GOOD_WORDS = frozenset("article main content post story body entry text prose".split())
_BAD_WORDS = frozenset("""ad ads advert advertisement banner nav navbar navigation menu footer header sidebar side aside
comment comments reply replies discussion disqus notice cookie cookies consent gdpr popup modal overlay share sharing
social related recommended promo promoted sponsor sponsored newsletter subscribe signup login breadcrumb breadcrumbs
widget toolbar tags tagcloud pager pagination copyright legal disclaimer alert toast search form masthead topbar
bottombar teaser outbrain taboola contentinfo complementary""".split())
_WORDS = re.compile(r"[a-z]+")
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[^>=]++)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_HINTS = frozenset("class id role itemprop aria-label".split())
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")

#: Weights of the block classifier: the logarithm of the odds that a block is main text.
WEIGHTS = {"bias": -0.4, "good": 2.5, "bad": -6.0, "heading": 1.0, "paragraph": 0.8, "words": 0.25, "links": -3.0, "stops": 0.3}
#: Smoothness: of neighbours in page order, and of blocks that share their container.
ADJACENT, SHARED = 0.6, 0.9
INFINITE = 1e9


class Block(NamedTuple):
    text: str
    never: bool
    good: bool
    bad: bool
    heading: bool
    paragraph: bool
    linked: float
    container: int
    depth: int
    wrapper: int


class Open(NamedTuple):
    """An open element, with what its ancestors and it say together, so that nothing looks through them again."""
    tag: str
    block: str      #: tag of the innermost block-level element
    depth: int      #: block-level elements
    links: int
    never: bool
    named: bool     #: a good name, or an article or main element
    bad: bool       #: of a bad container and an article or main element, the inner one counts
    article: bool   #: in an article or main element
    own: bool       #: in one that lies within the innermost wrapper
    paragraph: bool
    box: int        #: nearest container
    wrapper: int


class Wrapper(NamedTuple):
    parent: int
    tag: str
    bad: bool


_ROOT = Open("", "", 0, 0, False, False, False, False, False, False, 0, 0)


def _opened(up: Open, tag: str, attrs: str, node: int, wrappers: list[Wrapper]) -> Open:
    """The frame of a start tag below ``up``."""
    words: set[str] = set()
    hidden = link = False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in _HINTS:
            words.update(_WORDS.findall(value.lower()))
        hidden = (hidden or name == "hidden" or name == "style" and bool(_HIDDEN_STYLE.search(value))
                  or name == "aria-hidden" and value.strip().lower() == "true")
        link = link or name == "href"
    # the header of an article is its headline, not the page's
    bad = bool((words - {"header"} if up.article else words) & _BAD_WORDS) and tag not in ("html", "body")
    article = tag in ("article", "main") and not bad
    wraps = tag in WRAPPERS and not (tag == "header" and up.article)
    if wraps:
        wrappers.append(Wrapper(up.wrapper, tag, bad))
    block = tag in BLOCKS
    return Open(tag, tag if block else up.block, up.depth + block, up.links + (link and tag == "a"),
                up.never or hidden or tag in NEVER, up.named or article or not bad and bool(words & _GOOD_WORDS),
                bad or up.bad and not article, up.article or article, article or up.own and not wraps,
                up.paragraph or tag == "p", node if block and tag not in HEADINGS and tag not in ("p", "li") else up.box,
                len(wrappers) - 1 if wraps else up.wrapper)


def _boilerplate(wrappers: list[Wrapper], sizes: list[list[int]]) -> list[bool]:
    """Which wrappers bind their blocks to boilerplate.

    ``sizes``: for each wrapper (the first stands for the page) the characters of its blocks that lie in no inner
    wrapper: all of them, those in an article or main element, and those in one that lies in this wrapper.
    """
    n = len(wrappers)
    whole, own = [x[0] for x in sizes], [x[2] for x in sizes]
    for i in range(n - 1, 0, -1):
        whole[wrappers[i].parent] += whole[i]
        own[wrappers[i].parent] += own[i]

    def bound(freed: list[bool]) -> list[bool]:
        out = [False] * n
        for i in range(1, n):
            out[i] = not freed[i] or out[wrappers[i].parent]
        return out

    freed = [x.tag == "form" and own[i] > 0 for i, x in enumerate(wrappers)]
    out = bound(freed)
    if sum(x[1] for x, shut in zip(sizes, out) if not shut):
        return out
    # no article lies in the open
    return bound([freed[i] or own[i] > 0 or x.tag == "form" and not x.bad and 2 * whole[i] >= whole[0]
                  for i, x in enumerate(wrappers)])


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without empty ones."""
    out: list[Block] = []
    stack: list[Open] = [_ROOT]
    places: dict[str, list[int]] = {}  # of the open elements by tag
    wrappers = [Wrapper(0, "", False)]
    sizes: dict[int, list[int]] = {}
    nodes = 0
    parts: list[str] = []
    linked = 0
    raw_end: str | None = None

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            x = stack[-1]
            if not x.never:
                size = sizes.setdefault(x.wrapper, [0, 0, 0])
                for k, counts in enumerate((True, x.article and not x.bad, x.own and not x.bad)):
                    size[k] += len(text) * counts
            out.append(Block(text, x.never, x.named and not x.bad, x.bad, x.block in HEADINGS,
                             x.paragraph or x.block in ("blockquote", "pre", "li"),
                             linked / max(1, len(text)), x.box, x.depth, x.wrapper))
        linked = 0

    def cut(to: int) -> None:
        for x in stack[to:]:
            places[x.tag].pop()
        del stack[to:]

    at = 0
    while at <= len(page):
        if raw_end:
            end = re.compile(rf"</{re.escape(raw_end)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else len(page)
            parts.append(entities.unescape(page[at:stop]) if raw_end in ("title", "textarea") else "")
            at, raw_end = stop, None
        m = _TAG.search(page, at)
        text = entities.unescape(page[at:m.start() if m else len(page)])
        if text:
            parts.append(text)
            linked += len(text) if stack[-1].links else 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCKS:
                close()
            if places.get(tag):
                i = places[tag][-1]
                if tag in BLOCKS or stack[-1].depth == stack[i].depth:
                    cut(i)
            continue
        if tag in BLOCKS:
            close()
        if tag in VOID:
            parts.append(" " if tag == "br" else "")
            continue
        if tag in ENDS_PARAGRAPH and stack[-1].block == "p":
            # with all inline elements left open in it
            cut(places["p"][-1])
        nodes += 1
        places.setdefault(tag, []).append(len(stack))
        stack.append(_opened(stack[-1], tag, m[3] or "", nodes, wrappers))
        if tag in RAW:
            raw_end = tag
    close()
    shut = _boilerplate(wrappers, [sizes.get(i, [0, 0, 0]) for i in range(len(wrappers))])
    return [b._replace(never=True) if shut[b.wrapper] else b for b in out]


def _odds(b: Block) -> float:
    """Logarithm of the odds that a block is main text."""
    w = WEIGHTS
    n = b.text.count(" ") + 1
    stops = sum(b.text.count(x) for x in ".,;:!?")
    return (w["bias"] + w["good"] * b.good + w["bad"] * b.bad + w["heading"] * b.heading + w["paragraph"] * b.paragraph
            + w["words"] * math.log1p(n) + w["links"] * min(1.0, b.linked) + w["stops"] * min(3, stops))


def max_flow(n: int, edges: list[tuple[int, int, float, float]], s: int, t: int) -> list[bool]:
    """Dinic's algorithm; which nodes the minimum cut leaves on the side of ``s``. Edges: (u, v, there, back)."""
    to: list[int] = []
    cap: list[float] = []
    adj: list[list[int]] = [[] for _ in range(n)]
    for u, v, c, back in edges:
        adj[u].append(len(to))
        to.append(v)
        cap.append(c)
        adj[v].append(len(to))
        to.append(u)
        cap.append(back)
    while True:
        level = [-1] * n
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in adj[u]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level]
        nxt = [0] * n
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(cap[e] for e in path)
                cut = len(path)
                for i, e in enumerate(path):
                    cap[e] -= push
                    cap[e ^ 1] += push
                    if cap[e] <= 1e-9 and i < cut:
                        cut = i
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[u] < len(adj[u]):
                e = adj[u][nxt[u]]
                if cap[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(adj[u]):
                e = adj[u][nxt[u]]
                path.append(e)
                u = to[e]
            elif u == s:
                break
            else:
                level[u] = -1
                e = path.pop()
                u = to[e ^ 1]
                nxt[u] += 1


def main_text(page: str) -> str:
    """The main text of a page: its content blocks, one a line."""
    bs = blocks_of(page or "")
    if not bs:
        return ""
    n = len(bs)
    s, t = n, n + 1
    edges: list[tuple[int, int, float, float]] = []
    seen: dict[int, int] = {}
    for i, b in enumerate(bs):
        z = _odds(b)
        if b.never:
            edges.append((i, t, INFINITE, 0.0))
        elif z >= 0:
            edges.append((s, i, z, 0.0))
        else:
            edges.append((i, t, -z, 0.0))
        if i:
            c = ADJACENT / (1 + abs(b.depth - bs[i - 1].depth))
            edges.append((i - 1, i, c, c))
        if b.container in seen and seen[b.container] != i - 1:
            edges.append((seen[b.container], i, SHARED, SHARED))
        elif b.container in seen:
            edges.append((i - 1, i, SHARED, SHARED))
        seen[b.container] = i
    side = max_flow(n + 2, edges, s, t)
    return "\n".join(b.text for i, b in enumerate(bs) if side[i])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x or "") for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(x) for x in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
