"""Main text of HTML pages by minimum-cut labelling of text blocks.

A page is read into text blocks in page order. A logistic classifier over
block features gives each block a probability of being main text; its two
log-costs become the capacities between the block and the two terminals.
Smoothness edges join neighbouring blocks (stronger the closer their elements
are in the DOM) and each block to the next block of the same parent element. The
minimum cut of that network is the cheapest consistent labelling; the blocks
on the content side are the text.

The classifier is trained here, without labelled pages: blocks whose markup
says what they are (navigation, footer, advert, article, ...) are the examples, and in
half of them the markup features are hidden, so that text, links and position learn
to stand in where a page has plain ``div`` elements only.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortline.llm.common import fresh, slices

#: Different pages of the classifier's training sample, about (those with a low hash of their html).
TRAIN_PAGES = 2000
#: Weight of the edge between neighbours with the same parent; less with more DOM steps between.
NEIGHBOUR = 0.8
#: Weight of the edge to the next block of the same parent element.
SIBLING = 1.0

#: Elements whose content is read as raw text up to their end tag, or to the end of the page.
RAW = frozenset("script style noscript textarea iframe title".split())
#: Elements whose content is not shown; they end by nesting.
UNSEEN = frozenset("svg canvas template annotation annotation-xml".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section
    select button label summary table tbody tfoot thead tr ul option""".split())
SPACE = frozenset("br td th img input wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IMPLIED_END = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "option": "option"}
BOILER_TAGS = frozenset("nav footer aside form menu button select label fieldset dialog option".split())
CONTENT_TAGS = frozenset("article main".split())
#: Words of class, id and role attributes.
BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus footer form gdpr
    header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup privacy promo
    promoted promotion reactions recommended related replies reply respond search share sharing sidebar signup skip social
    sponsor sponsored subscribe tags toolbar topbar widget widgets alert""".split())
CONTENT_WORDS = frozenset("article articlebody content entry main maincontent post postbody story".split())
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""", re.S | re.X)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I | re.S)
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>]|$)[^>]*>?", re.I) for name in RAW}
_UNSEEN = re.compile(f"<(?:{'|'.join(sorted(UNSEEN))})(?=[\\s/>])", re.I)
_WORD = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ENDS = re.compile(r"[.!?:;,](?=\s|$)")

FEATURES = ("bias", "boiler", "content", "links", "words", "ends", "heading", "item", "place", "first", "last")
MARKUP = (1, 2)
#: Prior examples (main text or not, features): what markup names is decided by it, however
#: long or late the block; many links speak against main text.
PRIOR = (
    (0, {"boiler": 1, "words": 2}), (0, {"boiler": 1, "words": 7, "place": 0.5}),
    (0, {"boiler": 1, "words": 7, "place": 1}), (0, {"boiler": 1, "words": 3, "heading": 1, "place": 1}),
    (1, {"content": 1, "words": 1}), (1, {"content": 1, "words": 1, "place": 1, "last": 1}),
    (1, {"content": 1, "words": 1, "first": 1}), (1, {"content": 1, "words": 2, "item": 1, "place": 0.5}),
    (0, {"words": 2, "links": 1}), (0, {"words": 4, "links": 1, "place": 0.5}),
)

#: Prior examples that say what main text looks like where no markup names it: longer blocks with
#: sentence ends and few links, a heading before them; boilerplate is short, linked, or at the edges. Each weighs as
#: much as one block of the table, so they count for little beside some pages whose markup says more.
PLAIN = (
    (1, {"words": 3, "ends": 0.1, "place": 0.3}), (1, {"words": 3.7, "ends": 0.1, "place": 0.6}),
    (1, {"words": 2.2, "ends": 0.15, "place": 0.5}), (1, {"words": 4.5, "ends": 0.1, "first": 1}),
    (1, {"words": 4.5, "ends": 0.1, "place": 1, "last": 1}), (1, {"words": 1.8, "heading": 1, "place": 0.2}),
    (1, {"words": 2.5, "ends": 0.1, "item": 1, "place": 0.5}), (1, {"words": 3.4, "ends": 0.1, "links": 0.2, "place": 0.5}),
    (0, {"words": 1.1, "links": 1}), (0, {"words": 1.1, "links": 1, "place": 0.9}),
    (0, {"words": 1.6, "links": 1, "item": 1, "place": 0.1}), (0, {"words": 2.2, "links": 1, "item": 1, "place": 0.8}),
    (0, {"words": 2.2, "links": 0.6, "place": 0.9}), (0, {"words": 1.1, "place": 0.5}), (0, {"words": 1.1, "first": 1}),
    (0, {"words": 1.5, "place": 1, "last": 1}), (0, {"words": 3, "links": 0.9, "place": 0.5}),
)


@lru_cache(maxsize=20_000)
def class_says(name: str) -> str:
    """What one class, id or role says of its element: ``boiler``, ``content``
    or nothing. Its first and last words count as boilerplate words (main-nav, comment-list);
    "with-sidebar" and its like only speak of the layout, and an
    article-header holds the title."""
    words = _WORD.findall(_HUMP.sub(" ", name).lower())
    if not words or words[0] in ("has", "with", "no", "without"):
        return ""
    if words[-1] == "header" and not {"article", "post", "entry", "story"}.isdisjoint(words):
        return ""
    if words[0] in BOILER_WORDS or words[-1] in BOILER_WORDS:
        return "boiler"
    return "content" if not CONTENT_WORDS.isdisjoint(words) else ""


class Element:
    """An open element: its place in the tree and what its markup says."""

    __slots__ = ("name", "parent", "depth", "boiler", "content")

    def __init__(self, name: str, attrs: str, parent: Element | None) -> None:
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        inside = parent.content if parent else False
        boiler = name in BOILER_TAGS or (name == "header" and not inside)
        content = name in CONTENT_TAGS
        if attrs and name not in ("html", "body"):
            says = [said for m in _NAMED.finditer(attrs) for c in m[2].strip("\"'").split() if (said := class_says(c))]
            boiler = boiler or "boiler" in says
            content = content or "content" in says and "boiler" not in says
            boiler = boiler or bool(HIDDEN.search(attrs))
        self.boiler = boiler or (parent.boiler if parent else False)
        self.content = content or inside


def distance(a: Element, b: Element) -> int:
    """Steps from one element to the other in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


class Block:
    __slots__ = ("text", "element", "linked", "size")

    def __init__(self, text: str, element: Element, linked: int, size: int) -> None:
        self.text, self.element, self.linked, self.size = text, element, linked, size


def after_raw(page: str, name: str, at: int) -> int:
    """Where the content of a raw-text element that starts at ``at`` is over, end tag included."""
    close = _RAW_END[name].search(page, at)
    return close.end() if close else len(page)


def unseen(page: str) -> dict[int, int]:
    """Where the content of UNSEEN elements begins, and where the page goes on.

    Elements are matched by nesting. An svg without an end tag ends where its parent does, or at
    a block of the page; others left open hide nothing.
    """
    over: dict[int, int] = {}
    if not _UNSEEN.search(page):
        return over
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()

    def pop(closing: str, at: int, end: int) -> None:
        while True:
            name, begin = stack.pop()
            opened[name] -= 1
            if name == closing:
                if name in UNSEEN:
                    over[begin] = end
                return
            if name == "svg":
                over[begin] = at

    at = 0
    while m := _TAG.search(page, at):
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            if opened[name]:
                pop(name, m.start(), at)
            continue
        foreign = opened["svg"] > opened["foreignobject"]
        if foreign and name in BLOCK:
            while opened["svg"] > opened["foreignobject"]:
                pop("svg", m.start(), m.start())
            foreign = False
        if name in VOID or (m["attrs"] or m["attrs2"] or "").endswith("/") and (foreign or name in ("svg", "math")):
            continue
        if name in RAW and not foreign:
            at = after_raw(page, name, at)
        else:
            stack.append((name, at))
            opened[name] += 1
    while opened["svg"]:
        pop("svg", len(page), len(page))
    return over


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in page order; scripts, styles, drawings and comments
    never become blocks. An unfinished tag at the end of the page is dropped."""
    at, end = 0, len(page)
    over = unseen(page)
    here = Element("html", "", None)
    out: list[Block] = []
    held: list[str] = []
    linked = size = link = 0

    def flush() -> None:
        nonlocal held, linked, size
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Block(text, here, linked, size))
            held, linked, size = [], 0, 0

    while at < end:
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            held.append(text)
            n = len(text)
            size += n
            if link:
                linked += n
        if m is None:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if name == "a":
                link = max(0, link - 1)
            elif name in BLOCK:
                flush()
                link = 0
                up = here
                while up.parent is not None and up.name != name:
                    up = up.parent
                if up.parent is not None:
                    here = up.parent
            elif name in SPACE:
                held.append(" ")
            continue
        if name in RAW:
            at = after_raw(page, name, at)
        elif name in UNSEEN:
            at = over.get(at, at)
        elif name == "a":
            link = 1
        elif name in SPACE:
            held.append(" ")
        elif name in BLOCK:
            flush()
            link = 0
            ends = IMPLIED_END.get(name, "").split() + ["p"]
            if here.name in ends or here.name == name and name in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                here = here.parent or here
            if name not in VOID and name not in ("html", "body", "head"):
                here = Element(name, m["attrs"] or m["attrs2"] or "", here)
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    n = len(found)
    x = np.zeros((n, len(FEATURES)))
    for i, b in enumerate(found):
        words = b.text.count(" ") + 1
        x[i] = (1, b.element.boiler, b.element.content and not b.element.boiler, b.linked / max(b.size, 1), log(1 + words),
                len(_ENDS.findall(b.text)) / words, b.element.name[0] == "h" and b.element.name[1:].isdigit(),
                b.element.name in ("li", "option", "dt"), i / n, i == 0, i == n - 1)
    return x


def train(x: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic weights from the blocks whose markup names their kind.

    Each example is used twice, once with its markup features hidden. Prior
    examples say that markup is right, and what main text looks like without any, so that a
    sample without markup still gives a classifier.
    """
    boiler, content = x[:, 1] > 0, (x[:, 2] > 0) & (x[:, 1] == 0)
    known = boiler | content
    plain = x[known].copy()
    plain[:, MARKUP] = 0
    before = (*PRIOR, *PLAIN)
    prior = np.zeros((len(before), len(FEATURES)))
    for row, (_, named) in zip(prior, before):
        row[0] = 1
        for name, value in named.items():
            row[FEATURES.index(name)] = value
    rows = np.vstack([x[known], plain, prior])
    own = np.concatenate([content[known], content[known]]).astype(float)
    y = np.concatenate([own, [kind for kind, _ in before]])
    share = [max(own.sum(), 1), max((1 - own).sum(), 1)]
    weight = np.concatenate([np.where(own > 0, max(share) / share[0], max(share) / share[1]),
                             np.full(len(PRIOR), max(known.sum(), 1) / 20), np.ones(len(PLAIN))])
    weight /= weight.sum()
    w = np.zeros(rows.shape[1])
    scale = np.maximum(np.abs(rows).max(axis=0), 1)
    z = rows / scale
    ridge = 1e-4
    for _ in range(rounds):  # Newton steps; few are needed
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + ridge * w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w / scale


def max_flow_labels(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes end on the source side of a minimum cut.

    ``source[i]`` and ``sink[i]`` are the terminal capacities of node i, the
    edges are undirected. Nodes whose terminal outweighs all their edges are
    decided at once and folded into the terminals (they are on that side in every
    minimum cut); augmenting paths (breadth first) settle the others.
    """
    n = len(source)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        near[a].append((b, c))
        near[b].append((a, c))
    excess = [s - t for s, t in zip(source, sink)]
    pull = [sum(c for _, c in e) for e in near]
    side: list[bool | None] = [None] * n
    todo = [i for i in range(n) if abs(excess[i]) > pull[i]]
    while todo:
        i = todo.pop()
        if side[i] is not None:
            continue
        side[i] = excess[i] > 0
        for j, c in near[i]:
            if side[j] is None:
                excess[j] += c if side[i] else -c
                pull[j] -= c
                if abs(excess[j]) > pull[j]:
                    todo.append(j)
    left = [i for i in range(n) if side[i] is None]
    if not left:
        return side  # type: ignore[return-value]
    flow: dict[int, dict[int, float]] = {i: {} for i in left}
    for i in left:
        for j, c in near[i]:
            if side[j] is None:
                flow[i][j] = flow[i].get(j, 0.0) + c
    come = {i: max(excess[i], 0.0) for i in left}
    go = {i: max(-excess[i], 0.0) for i in left}
    tiny = 1e-9
    while True:
        back: dict[int, int] = {i: -1 for i in left if come[i] > tiny}
        queue = list(back)
        target = None
        for i in queue:
            if go[i] > tiny:
                target = i
                break
            for j, c in flow[i].items():
                if c > tiny and j not in back:
                    back[j] = i
                    queue.append(j)
        if target is None:
            for i in left:
                side[i] = i in back
            return side  # type: ignore[return-value]
        path = [target]
        while back[path[-1]] >= 0:
            path.append(back[path[-1]])
        amount = min(go[target], come[path[-1]], *(flow[b][a] for a, b in zip(path, path[1:])))
        go[target] -= amount
        come[path[-1]] -= amount
        for a, b in zip(path, path[1:]):
            flow[b][a] -= amount
            flow[a][b] = flow[a].get(b, 0.0) + amount


def label(found: list[Block], p: np.ndarray) -> list[bool]:
    """Content or not, per block, from the classifier's probabilities."""
    p = np.clip(p, 1e-4, 1 - 1e-4)
    as_boiler, as_content = (-np.log(1 - p)).tolist(), (-np.log(p)).tolist()
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            steps = max(1, distance(found[i - 1].element, b.element) - 1)
            edges.append((i - 1, i, NEIGHBOUR / steps ** 2))
        parent = id(b.element.parent)
        if parent in last:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    return max_flow_labels(as_boiler, as_content, edges)


def fit(pages: DataFrame, url_col: str = "url", html_col: str = "html", sample: int = TRAIN_PAGES) -> np.ndarray:
    """Train the classifier on about ``sample`` pages, on all their blocks whose markup names
    their kind (:func:`train` uses no others): 44 bytes a block come to the driver.

    Pages are chosen by a hash of their html, each different html once, so neither copies nor
    null or repeated addresses (``url_col`` is not looked at) bring more than one page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [x[x[:, MARKUP].any(axis=1)] for t in batch.column(0).to_pylist() if len(x := features(blocks(t or "")))]
            flat = np.vstack(rows).astype("<f4").tobytes() if rows else b""
            yield pa.RecordBatch.from_arrays([pa.array([flat], pa.binary())], names=["x"])

    texts = pages.select(F.col(html_col).cast("string").alias("h")).where("h is not null").withColumn("k", F.xxhash64("h"))
    share = int(1e15 * min(1.0, sample / max(texts.select("k").distinct().count(), 1)))
    some = texts.where(F.pmod("k", F.lit(10 ** 15)) < share).select("h").distinct()
    got = some.select("h").mapInArrow(run, "x binary").collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in got), "<f4").reshape(-1, len(FEATURES)).astype(float)
    return train(x)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "main_text",
            weights: np.ndarray | None = None, url_col: str = "url") -> DataFrame:
    """``pages`` plus ``out_col``: the main text, its blocks joined by a newline.

    Null, empty or contentless html gives an empty text. Every other column
    and every row (repeated ones too) is kept as it is; if the table already has a column
    called ``out_col``, underscores are added to the new one's name. Nothing is cut from long pages.
    """
    out_col = fresh(out_col, pages.columns)
    w = fit(pages, url_col, html_col) if weights is None else weights
    place = pages.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for page in batch.column(place).to_pylist():
                found = blocks(page or "")
                if not found:
                    out.append("")
                    continue
                p = 1 / (1 + np.exp(-np.clip(features(found) @ w, -30, 30)))
                out.append("\n".join(b.text for b, keep in zip(found, label(found, p)) if keep))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             names=[*batch.schema.names, out_col])

    schema = StructType([*pages.schema.fields, StructField(out_col, StringType())])
    return pages.mapInArrow(run, schema)


def op10_mincut_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (contract of the query)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    done = extract(pages)
    return done.select("page_id", "url", F.col("main_text").alias("text"),
                       F.length("main_text").cast("long").alias("n_chars"))
