"""Main text of web pages: boosted trees over DOM nodes and a hierarchical decoding.

1. A page is cut into tags and text; block elements become nodes of a tree, text runs belong to the block they stand in.
   What is never text (head, scripts, styles, templates, comments) is left out by the parser.
2. Every node gets numbers: its subtree's text, link and tag density, sentence marks, depth, place, statistics of its
   siblings, its kind of tag, words of its class, id and role, and the same of its ancestors.
3. Gradient-boosted trees (logistic loss, histogram splits, numpy) give each node the probability that its subtree is
   main text. They are trained on a bounded sample of the pages: the parts that ``article`` or ``main`` mark there, and the
   same parts laid into other layouts (menus, sidebars, notices, forms, adverts and comments around them), where the right
   answer is known because the layout was built.
4. Decoding is one pass up and down the tree: a node is taken whole, dropped whole, or its children decide. So a taken
   node never stands in a dropped one, and the choice with the highest likelihood wins.

The text: character references decoded, white space of a block one space, trimmed, blocks joined in page order by a space.

Defined cases: NULL or empty html and pages without main text give an empty text; unclosed and crossing tags are closed
as browsers do for paragraphs and list items; a silent element (``SILENT``) without its end tag ends at the next block or with
the block it stands in, a head at the first thing that no head holds; a cut-off tag at the end is dropped; repeated rows give equal results; very long
pages are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import one_blas_thread, sample_rows, ship_package

SAMPLE_PAGES = 300
TREES = 40
DEPTH = 3
RATE = 0.25
BINS = 32

# Kinds of HTML elements.
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form table thead "
    "tbody tfoot tr td th caption pre blockquote figure figcaption fieldset address details summary dialog hr menu "
    "center legend".split()
)
SILENT = frozenset("head script style noscript template svg iframe textarea select datalist option canvas".split())
HEAD = frozenset("base basefont bgsound link meta title script style noscript template noframes".split())  # what a head may hold
RAW = frozenset("script style textarea title".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
CLOSES_P = BLOCKS - {"html", "body"}
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
GROUPS = (
    {"article", "main"}, {"section"}, {"div", "center"}, {"p", "pre", "blockquote", "address"},
    {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "menu"}, {"li", "dt", "dd"}, {"nav"}, {"header"},
    {"footer"}, {"aside"}, {"form", "fieldset", "dialog"}, {"table", "tr", "td", "th", "tbody", "thead"},
    {"figure", "figcaption", "caption"},
)
GOOD_WORDS = frozenset("article content post entry main body story text blog page maincontent".split())
BAD_WORDS = frozenset(
    "nav navbar menu sidebar side footer foot header head masthead ad ads advert advertisement sponsor sponsored banner "
    "promo cookie cookies notice consent gdpr popup modal alert comment comments reply replies discussion respond share "
    "social related recommended newsletter subscribe signup breadcrumb breadcrumbs widget form login search copyright "
    "legal tags pagination pager toolbar".split()
)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|data-k)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKENS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: frozenset = frozenset()
    mark: str = ""  # of built training pages: "1" main text, "0" not
    children: list[int] = field(default_factory=list)
    chars: int = 0  # of its own runs
    link_chars: int = 0
    tags: int = 0
    marks: int = 0
    runs: int = 0


@dataclass
class Page:
    nodes: list[Node]
    runs: list[tuple[int, str]]  # (node, text), in page order


def parse(page: str) -> Page:
    """The block tree of a page and its text runs."""
    nodes = [Node("#root", -1, 0)]
    stack = [0]
    runs: list[tuple[int, str]] = []
    buf: list[str] = []
    silent: list[tuple[str, bool]] = []  # open silent elements; True: nothing closes it, so a block's edge does
    links = link_from = 0

    def flush() -> None:
        nonlocal buf, link_from
        if not buf:
            return
        text = " ".join(html_lib.unescape("".join(buf)).split())
        buf = []
        if text:
            n = nodes[stack[-1]]
            n.chars += len(text)
            n.runs += 1
            n.marks += sum(map(text.count, ".!?,;:"))
            if links or link_from:
                n.link_chars += min(len(text), link_from) if not links else len(text)
            runs.append((stack[-1], text))
        link_from = 0

    def text(s: str) -> None:
        nonlocal link_from
        if silent and silent[-1][0] == "head" and s.strip():
            silent.pop()
        if not silent and s:
            buf.append(s)
            if links:
                link_from += len(s.strip())

    def close(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if nodes[stack[k]].tag == tag:
                flush()
                del stack[k:]
                return

    def end_silence() -> None:
        while silent and silent[-1][1]:
            silent.pop()

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            rest = page[at:]
            cut = rest.rfind("<")
            if cut >= 0 and ">" not in rest[cut:] and re.match(r"</?[a-zA-Z!]|<\Z", rest[cut:]):
                rest = rest[:cut]  # a tag that the page's end cuts off
            text(rest)
            break
        text(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            names_open = [t for t, _ in silent]
            if names_open and tag == names_open[-1]:
                silent.pop()
                continue
            if tag in names_open:
                del silent[names_open.index(tag) :]
                continue
            if tag in BLOCKS and any(nodes[k].tag == tag for k in stack):
                end_silence()
            if silent:
                continue
            if tag in BLOCKS:
                close(tag)
            elif tag == "a":
                links = max(0, links - 1)
            continue
        if tag in BLOCKS:
            end_silence()
        if silent and silent[-1][0] == "head" and tag not in HEAD:
            silent.pop()
        if tag in RAW:
            # Up to its own end tag nothing is markup.
            stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in SILENT:
            if not m.group(3).rstrip().endswith("/"):
                if silent and silent[-1] == (tag, True):
                    silent.pop()
                follows = re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).search(page, at)
                silent.append((tag, tag == "head" or follows is None or not follows.group(1)))
            continue
        if tag == "body" and silent:
            silent = []
        if silent:
            continue
        nodes[stack[-1]].tags += 1
        if tag in BLOCKS:
            flush()
            links = 0
            if tag in CLOSES_P and nodes[stack[-1]].tag == "p":
                stack.pop()
            if tag in CLOSED_BY_SAME:
                for k in range(len(stack) - 1, 0, -1):
                    t = nodes[stack[k]].tag
                    if t == tag:
                        del stack[k:]
                        break
                    if t in CLOSED_BY_SAME[tag]:
                        break
            if tag in VOID:
                continue
            attrs = {a.lower(): x or y or z for a, x, y, z in _ATTR.findall(m.group(3))}
            names = " ".join(attrs.get(k, "") for k in ("class", "id", "role"))
            words = frozenset(_TOKENS.findall(_CAMEL.sub(" ", names).lower()))
            nodes.append(Node(tag, stack[-1], len(stack), words, attrs.get("data-k", "")))
            nodes[stack[-1]].children.append(len(nodes) - 1)
            stack.append(len(nodes) - 1)
        elif tag == "br":
            buf.append(" ")
        elif tag == "a":
            links += 1
    flush()
    return Page(nodes, runs)


def features(page: Page) -> np.ndarray:
    """A row of numbers for each node."""
    nodes = page.nodes
    n = len(nodes)
    own = np.array([(x.chars, x.link_chars, x.tags, x.marks, x.runs) for x in nodes], float)
    total = own.copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        total[nodes[i].parent] += total[i]
    chars = total[:, 0]
    group = np.zeros((n, len(GROUPS)))
    good, bad = np.zeros((n, 2)), np.zeros((n, 2))
    inside = np.zeros((n, 3))  # below article or main; nav, header, footer, aside or form; list
    sib = np.zeros((n, 5))
    before = np.zeros(n)
    seen = 0.0
    for i, x in enumerate(nodes):
        before[i] = seen
        seen += own[i, 0]
        for g, tags in enumerate(GROUPS):
            if x.tag in tags:
                group[i, g] = 1
        good[i, 0], bad[i, 0] = len(x.words & GOOD_WORDS), len(x.words & BAD_WORDS)
        if x.parent >= 0:
            p = x.parent
            good[i, 1], bad[i, 1] = good[p].max(), bad[p].max()
            inside[i] = inside[p]
            if nodes[p].tag in ("article", "main"):
                inside[i, 0] = 1
            elif nodes[p].tag in ("nav", "header", "footer", "aside", "form", "dialog"):
                inside[i, 1] = 1
            elif nodes[p].tag in ("ul", "ol", "menu"):
                inside[i, 2] = 1
    for x in nodes:
        c = x.children
        if c:
            k = np.array(c)
            t = chars[k]
            same = [nodes[j].tag for j in c]
            for place, j in enumerate(c):
                sib[j] = (len(c), place / len(c), same.count(same[place]) / len(c), chars[j] / max(1.0, t.sum()), t.mean())
    whole = max(1.0, chars[0])
    return np.column_stack([
        np.log1p(chars), chars / whole, total[:, 1] / np.maximum(chars, 1), total[:, 2] / np.maximum(chars, 1) * 100,
        total[:, 3] / np.maximum(chars, 1) * 100, chars / np.maximum(total[:, 4], 1), np.log1p(own[:, 0]),
        [x.depth for x in nodes], [len(x.children) for x in nodes], before / whole, sib, group, good, bad, inside,
    ])


@dataclass
class Trees:
    """Boosted trees of full depth: split features and thresholds by level order, leaf values."""

    base: float
    split: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for s, c, leaf in zip(self.split, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, s[at]] > c[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = TREES) -> Trees:
    """Gradient boosting with Newton leaves and histogram splits."""
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    code = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    flat = code + np.arange(f) * BINS
    p0 = min(max(float((w * y).sum() / w.sum()), 1e-3), 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    z = np.full(n, base)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    split, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = w * (y - p), w * p * (1 - p)
        at = np.zeros(n, np.int64)
        for d in range(DEPTH):
            for node in range(2**d - 1, 2 ** (d + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) < 20:
                    continue
                cells = flat[rows].ravel()
                gs = np.bincount(cells, np.repeat(g[rows], f), f * BINS).reshape(f, BINS).cumsum(axis=1)
                hs = np.bincount(cells, np.repeat(h[rows], f), f * BINS).reshape(f, BINS).cumsum(axis=1)
                G, H = gs[0, -1], hs[0, -1]
                gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
                gain[:, -1] = -1
                j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[j, b] > 1e-6 and b < len(edges[j]):
                    split[t, node], cut[t, node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), split[t][at]] > cut[t][at])
        last = at - inner
        gl, hl = np.bincount(last, g, leaves), np.bincount(last, h, leaves)
        leaf[t] = RATE * gl / (hl + 1)
        z += leaf[t][last]
    return Trees(base, split, cut, leaf)


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """True for the nodes whose own text is taken: the most likely choice without contradictions."""
    nodes = page.nodes
    odds = np.clip(odds, -8, 8)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    weight = np.sqrt(np.array([x.chars for x in nodes], float))
    take, drop = weight * yes, weight * no  # the subtree taken or dropped whole
    free = np.maximum(take, drop)  # its own text by itself, its children by themselves
    best = np.zeros(len(nodes))
    for i in range(len(nodes) - 1, -1, -1):
        best[i] = max(take[i], drop[i], free[i])
        p = nodes[i].parent
        if p >= 0:
            take[p] += take[i]
            drop[p] += drop[i]
            free[p] += best[i]
    state = np.zeros(len(nodes), np.int8)  # 1 taken whole, -1 dropped whole, 0 open
    out = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        up = state[x.parent] if x.parent >= 0 else 0
        if up:
            state[i] = up
        elif take[i] >= best[i]:
            state[i] = 1
        elif drop[i] >= best[i]:
            state[i] = -1
        out[i] = state[i] == 1 or (state[i] == 0 and odds[i] > 0)
    return out


def main_text(page: Page, odds: np.ndarray) -> str:
    taken = decode(page, odds)
    return " ".join(t for node, t in page.runs if taken[node])


def _part(page: str, tag: str) -> str:
    """The inner html of the first element of a kind."""
    m = re.search(rf"<{tag}\b[^>]*>(.*?)(?:</{tag}\s*>|\Z)", page, re.S | re.I)
    return m.group(1) if m else ""


def layouts(page: str, other: str) -> list[str]:
    """Training pages with known answers (attribute data-k): the page's own main part in several layouts."""
    inner = _part(page, "article") or _part(page, "main")
    if not inner.strip():
        return []
    nav = _part(page, "nav") or '<ul><li><a href="/a">home</a></li><li><a href="/b">about</a></li></ul>'
    foot = _part(page, "footer") or "&copy; all rights reserved"
    strange = " ".join(html_lib.escape(t) for _, t in parse(_part(other, "article") or other).runs)[:400]
    teaser = strange[:120]
    # A main part may be shorter than what stands around it: a heading and a sentence, or a sentence alone.
    said = " ".join(t for _, t in parse(inner).runs).split()
    heading, sentence = (html_lib.escape(" ".join(said[a:b])) for a, b in ((0, 6), (6, 18)))
    long_foot = f"{foot} {strange[: 80 + 7 * (len(page) % 40)]}"
    comments = "".join(f'<div class="comment"><p>{strange[i * 90 : i * 90 + 90]}</p></div>' for i in range(3))
    box = f'<div class="ad" data-k="0">{teaser}</div>'
    notice = f'<div class="cookie-notice" data-k="0"><p>{teaser}</p></div>'
    form = f'<form data-k="0"><p>{teaser}</p><input type="text"></form>'
    side = f'<aside data-k="0"><h3>{teaser[:30]}</h3><ul>{nav}</ul><p>{teaser}</p></aside>'
    return [
        f'<body><nav data-k="0">{nav}</nav>{box}<article data-k="1">{inner}</article><footer data-k="0">{foot}</footer></body>',
        f'<body><header data-k="0"><p>{teaser[:40]}</p>{nav}</header>{notice}<main data-k="1">{inner}</main>{side}'
        f'<section id="comments" data-k="0"><h2>{teaser[:20]}</h2>{comments}</section><footer data-k="0">{foot}</footer></body>',
        f'<body><div class="menu" data-k="0">{nav}</div><div class="wrap"><div class="content" data-k="1">{inner}</div>'
        f'<div class="sidebar" data-k="0"><p>{strange[:200]}</p>{nav}</div></div>{form}'
        f'<div class="footer" data-k="0"><p>{foot}</p></div></body>',
        f'<body>{box}<nav data-k="0">{nav}</nav><article><div data-k="1">{inner}</div><div class="comments" data-k="0">'
        f'{comments}</div>{box}</article>{side}<footer data-k="0"><p>{foot}</p>{nav}</footer></body>',
        f'<body><nav data-k="0">{nav}</nav>{box}<article data-k="1"><h1>{heading}</h1><p>{sentence}</p></article>'
        f'<footer data-k="0">{long_foot}</footer></body>',
        f'<body><header data-k="0">{nav}</header><div class="notice" data-k="0"><p>{strange[:300]}</p></div>'
        f'<main data-k="1"><p>{sentence or heading}</p></main><footer data-k="0"><p>{long_foot}</p></footer></body>',
    ]


def training_rows(pages: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, answers (share of the subtree's text that is main text, rounded) and weights."""
    xs, ys, ws = [], [], []
    for i, page in enumerate(pages):
        for built in layouts(page, pages[(i + 1) % len(pages)]):
            tree = parse(built)
            good = np.zeros(len(tree.nodes))
            known: list[str] = []
            for k, x in enumerate(tree.nodes):
                known.append(x.mark or (known[x.parent] if x.parent >= 0 else ""))
                good[k] = x.chars if known[k] == "1" else 0
            all_ = np.array([float(x.chars) for x in tree.nodes])
            for k in range(len(tree.nodes) - 1, 0, -1):
                good[tree.nodes[k].parent] += good[k]
                all_[tree.nodes[k].parent] += all_[k]
            share = good / np.maximum(all_, 1)
            use = (all_ > 0) & ((share < 0.1) | (share > 0.9))
            xs.append(features(tree)[use])
            ys.append((share > 0.5)[use].astype(float))
            ws.append(np.sqrt(all_[use]))
    if not xs:
        return np.zeros((0, 1)), np.zeros(0), np.zeros(0)
    w = np.concatenate(ws)
    return np.vstack(xs), np.concatenate(ys), w / w.mean()


def plain_pages(n: int = 60, seed: int = 5) -> list[str]:
    """Main parts of made-up words; the trees learn from them in the built layouts where no page marks its own."""
    rng = np.random.default_rng(seed)

    def text(words: int) -> str:
        w = ["".join(rng.choice(list("aeilnorst"), rng.integers(2, 9))) for _ in range(words)]
        return " ".join(x + rng.choice(["", "", "", "", ",", "."]) for x in w).capitalize() + "."

    return [
        f"<article><h1>{text(int(rng.integers(3, 12)))}</h1>"
        + "".join(f"<p>{text(int(rng.integers(5, 90)))}</p>" for _ in range(int(rng.integers(1, 9))))
        + "</article>"
        for _ in range(n)
    ]


def fit(pages: DataFrame, n: int = SAMPLE_PAGES) -> Trees:
    """Train on at most ``n`` pages (those with the smallest hashed ids)."""
    rows = sample_rows(pages.where(F.length("html") > 0).select("page_id", "html"), "page_id", n).collect()
    one_blas_thread()
    x, y, w = training_rows([r["html"] for r in rows])
    if not len(y) or y.min() == y.max():
        x, y, w = training_rows(plain_pages())
    return boost(x, y, w)


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html."""
    ship_package(pages.sparkSession)
    model = trees or fit(pages)

    def run(batches):
        for b in batches:
            texts = []
            htmls = b.column(2).to_pylist()
            for at in range(0, len(htmls), 64):  # the trees run once for the nodes of 64 pages
                parsed = [parse(h or "") for h in htmls[at : at + 64]]
                sizes = np.cumsum([len(p.nodes) for p in parsed])[:-1]
                odds = model.log_odds(np.vstack([features(p) for p in parsed]))
                texts += [main_text(p, o) for p, o in zip(parsed, np.split(odds, sizes))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
