"""HTML extraction: gradient-boosted trees over the nodes of a page's tree.

A page is read into a tree of its block elements; inline elements only mark
link text. Each node has features of its tag, attribute tokens, depth, text and
link density of its subtree, siblings and ancestors. Boosted trees give each
node the odds of being main text. Decoding is hierarchical: of all labellings in
which nothing below a dropped node is kept, the one of the largest summed odds
is taken, by dynamic programming over the tree, so that an ancestor's and a
descendant's choices never contradict each other.

The trees are trained in numpy on pages that ``synthetic_pages`` makes (layouts
with menus, headers, sidebars, notices, adverts, forms, comments, footers and
articles of many markups), since no labelled pages are given. The generator and
the training have fixed seeds and bounded sizes; the model is made once in the
driver and is a few kilobytes.

Text: character references are decoded, white space within a block becomes one
space, blocks are joined in page order by one newline. Scripts, styles,
templates and form controls have no text.

Defined results: null and empty pages, and pages without main text, give the
empty text; text outside all block elements is judged as a block of its own; a page cut off anywhere gives what stands before the cut; repeated
rows are extracted each; columns other than page_id, url and html are not
looked at.
"""

from __future__ import annotations

import builtins
import html as html_lib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split())
SKIP = set("script style noscript template textarea title select option button iframe svg math object audio video canvas head".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK - {"html", "body"}
LIST_LIKE = {"li": ("li", {"ul", "ol", "menu"}), "dd": ("dd dt", {"dl"}), "dt": ("dd dt", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"})}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_CUT = re.compile(r"<(?:[a-zA-Z!?/][^>]*)?\Z", re.S)
_ATTR = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")
WORDS = {
    "main": "article articlebody body content entry main post story text",
    "nav": "breadcrumb breadcrumbs menu menubar nav navbar navigation pager pagination skip sitemap toc tabs",
    "side": "aside complementary popular recommended related rail side sidebar trending widget widgets",
    "head": "banner brand header hero logo masthead top topbar",
    "foot": "bottom colophon contentinfo copyright footer legal",
    "ad": "ad ads advert advertisement adsense dfp outbrain promo promoted promotion sponsor sponsored taboola",
    "note": "alert consent cookie cookies disclaimer gdpr message modal notice notification overlay paywall popup privacy toast",
    "form": "contact form login newsletter register search signin signup subscribe subscription",
    "talk": "comment commentlist comments discussion disqus replies reply respond responses",
    "share": "byline meta share sharing social tags",
}
_GROUP = {w: k for k, ws in enumerate(WORDS.values()) for w in ws.split()}
TAGS = [("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("div", "section", "center"), ("article", "main"), ("nav", "menu"), ("header",), ("footer",), ("aside", "dialog"), ("ul", "ol", "dl"), ("li", "dd", "dt"), ("table", "tbody", "thead", "tr", "td", "th"), ("form", "fieldset"), ("blockquote", "pre", "figure", "figcaption")]
_TAGS = {t: k for k, ts in enumerate(TAGS) for t in ts}


class Page:
    """Nodes in page order: tag, parent, attribute groups, own runs of text."""

    __slots__ = ("tag", "parent", "depth", "groups", "runs", "length", "linked", "stops", "elements", "y", "outer")

    def __init__(self, source: str, mark: str | None = None):
        self.tag, self.parent, self.depth, self.groups = ["#"], [-1], [0], [0]
        self.length, self.linked, self.stops, self.elements, self.y = [0], [0], [0], [0], [1]
        self.runs: list[tuple[int, str]] = []  # node and text, in page order
        self.outer = 0
        self._read(source, mark)

    def _outside(self) -> int:
        """The node of text that stands outside all block elements: a body of its own, made when first needed."""
        if not self.outer:
            self.outer = len(self.tag)
            self.tag.append("body")
            for x, y in ((self.parent, 0), (self.depth, 1), (self.groups, 0), (self.length, 0), (self.linked, 0), (self.stops, 0), (self.elements, 0), (self.y, 1)):
                x.append(y)
        return self.outer

    def _read(self, source: str, mark: str | None) -> None:
        stack, parts, linked, in_link, at = [0], [], 0, 0, 0
        tag, n = self.tag, len(source)

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = "".join(parts)
                if "&" in text:
                    text = html_lib.unescape(text)
                text = " ".join(text.split())
                if text:
                    v = stack[-1] or self._outside()
                    self.runs.append((v, text))
                    self.length[v] += len(text)
                    self.linked[v] += min(linked, len(text))
                    self.stops[v] += text.count(".") + text.count(",")
                parts, linked = [], 0

        while at < n:
            m = _TAG.search(source, at)
            end = m.start() if m else n
            if end > at:
                text = source[at:end]
                if not m:
                    text = _CUT.sub("", text)
                parts.append(text)
                if in_link:
                    linked += len(text)
            if not m:
                break
            at = m.end()
            slash, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if name not in BLOCK:
                if slash:
                    if name == "a":
                        in_link = 0
                elif name == "a":
                    in_link = 1
                elif name == "br" or name == "hr":
                    if name == "hr":
                        flush()
                    parts.append(" ")
                elif name in SKIP and not attrs.endswith("/"):
                    if name == "head":
                        close = re.compile(r"</head\b[^>]*>|(?=<body\b)", re.I).search(source, at)
                    else:
                        close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                    at = close.end() if close else n
                self.elements[stack[-1]] += 1
                continue
            flush()
            in_link = 0
            if slash:
                for k in range(len(stack) - 1, 0, -1):
                    if tag[stack[k]] == name:
                        del stack[k:]
                        break
                continue
            if name in CLOSES_P and tag[stack[-1]] == "p":
                stack.pop()
            if name in LIST_LIKE:
                own, outer = LIST_LIKE[name]
                own = own.split()
                for k in range(len(stack) - 1, 0, -1):
                    t = tag[stack[k]]
                    if t in own:
                        del stack[k:]
                        break
                    if t in outer:
                        break
            if len(stack) > 200:  # deeper ones stand beside each other
                stack.pop()
            v = len(tag)
            tag.append(name)
            self.parent.append(stack[-1])
            self.depth.append(len(stack))
            g = 0
            if attrs:
                for a in _ATTR.findall(attrs):
                    for w in _TOKEN.findall((a[0] or a[1] or a[2]).lower()):
                        k = _GROUP.get(w)
                        if k is not None:
                            g |= 1 << k
            self.groups.append(g)
            self.y.append(0 if mark and mark in attrs else 1)
            for x in (self.length, self.linked, self.stops, self.elements):
                x.append(0)
            stack.append(v)
        flush()


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all nodes of all pages, the parent of each (-1 at roots), and where each page begins."""
    begin = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages])]).astype(np.int64)
    n = int(begin[-1])
    cat = lambda f, t=np.int64: np.fromiter((x for p in pages for x in f(p)), t, n)
    page = np.repeat(np.arange(len(pages)), np.diff(begin))
    parent = cat(lambda p: p.parent)
    root = parent < 0
    parent = np.where(root, -1, parent + begin[:-1][page])
    depth, groups = cat(lambda p: p.depth), cat(lambda p: p.groups)
    kind = cat(lambda p: [_TAGS.get(t, -1) for t in p.tag])
    own, linked, stops, elements = (cat(lambda p, a=a: getattr(p, a)).astype(float) for a in ("length", "linked", "stops", "elements"))
    sub = {"length": own.copy(), "linked": linked.copy(), "stops": stops.copy(), "nodes": elements + 1.0}
    up_kind, up_group = np.zeros(n, np.int64), np.zeros(n, np.int64)
    kind_bit = np.where(kind >= 0, 1 << np.maximum(kind, 0), 0)
    levels = [np.flatnonzero((depth == d) & ~root) for d in range(1, int(depth.max(initial=0)) + 1)]
    for at in reversed(levels):
        for x in sub.values():
            x += np.bincount(parent[at], x[at], n)
    for at in levels:
        up_kind[at] = up_kind[parent[at]] | kind_bit[parent[at]]
        up_group[at] = up_group[parent[at]] | groups[parent[at]]
    child = np.flatnonzero(~root)
    kids = np.bincount(parent[child], minlength=n).astype(float)
    kid_len = np.bincount(parent[child], sub["length"][child], n)
    pa_ = np.where(root, np.arange(n), parent)
    total = sub["length"][begin[:-1]][page] if n else own
    before = np.cumsum(own) - own
    before = before - before[begin[:-1]][page] if n else before
    cols = [
        depth, np.log1p(own), np.log1p(sub["length"]), linked / (own + 1), sub["linked"] / (sub["length"] + 1),
        sub["length"] / sub["nodes"], stops / (own + 1), sub["stops"] / (sub["length"] + 1), kids, kid_len / (kids + 1),
        np.log1p(sub["length"][pa_]), sub["linked"][pa_] / (sub["length"][pa_] + 1), kids[pa_], kid_len[pa_] / (kids[pa_] + 1),
        sub["length"] / (total + 1), before / (total + 1), sub["length"] / (sub["length"][pa_] + 1), kind[pa_],
    ]
    cols += [kind == k for k in range(len(TAGS))] + [(up_kind >> k) & 1 for k in range(3, 12)]
    cols += [(groups >> k) & 1 for k in range(len(WORDS))] + [(up_group >> k) & 1 for k in range(len(WORDS))]
    return np.stack(cols, 1).astype(np.float32) if n else np.zeros((0, len(cols)), np.float32), parent, begin


# --- boosted trees ----------------------------------------------------------


class Boosted:
    """Log odds by complete binary trees of one depth, fitted to gradients of the log loss on binned features."""

    def __init__(self, depth: int = 5, trees: int = 40, rate: float = 0.25, bins: int = 32):
        self.depth, self.trees, self.rate, self.bins = depth, trees, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        n, m = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)
        self.base = float(np.log((weight @ y + 1) / (weight @ (1 - y) + 1)))
        self.feature, self.cut, self.leaf = [], [], []
        f = np.full(n, self.base)
        b = self.bins
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            g, h = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf, np.float32)
            for d in range(self.depth):
                first, width = 2**d - 1, 2**d
                best, at = np.zeros(width), np.zeros((width, 2), np.int64)
                for j in range(m):
                    key = (node - first) * b + binned[:, j]
                    gs, hs = (np.bincount(key, v, width * b).reshape(width, b).cumsum(1) for v in (g, h))
                    gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    gain[(hl < 1) | (ht - hl < 1)] = 0
                    k = gain.argmax(1)
                    better = gain[np.arange(width), k] > best + 1e-9
                    best = np.where(better, gain[np.arange(width), k], best)
                    at[better] = np.stack([np.full(width, j), k], 1)[better]
                for i in range(width):
                    j, k = at[i]
                    if best[i] > 0 and k < len(self.edges[j]):
                        feature[first + i], cut[first + i] = j, self.edges[j][k]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + 1)
            f += value[leaf]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(value)
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            f += leaf[node - len(feature)]
        return f


def decode(odds: np.ndarray, parent: np.ndarray, depth: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the best sum of weighted odds with no kept node below a dropped one."""
    keep, drop = weight * odds, -weight * odds
    n = len(odds)
    levels = [np.flatnonzero((depth == d) & (parent >= 0)) for d in range(1, int(depth.max(initial=0)) + 1)]
    for at in reversed(levels):
        keep += np.bincount(parent[at], np.maximum(keep[at], drop[at]), n)
        drop += np.bincount(parent[at], drop[at], n)
    out = np.ones(n, bool)  # roots are kept; they only hold what stands below
    for at in levels:
        out[at] = out[parent[at]] & (keep[at] > drop[at])
    return out


# --- training pages ---------------------------------------------------------

_SYL = "ba ke lo ri su ten mar vel ino ast per qui don la mi ro ses tu an or".split()


def _sentence(r: random.Random, lo: int, hi: int) -> str:
    ws = ["".join(r.choice(_SYL) for _ in range(r.randint(1, 3))) for _ in range(r.randint(lo, hi))]
    for i in range(len(ws) - 1):
        if r.random() < 0.08:
            ws[i] += ","
    return " ".join(ws).capitalize() + ("." if r.random() < 0.9 else "?")


def _para(r: random.Random) -> str:
    text = " ".join(_sentence(r, 1, 18) for _ in range(r.choice((1, 1, 2, 3, 5, 9))))
    if r.random() < 0.15:
        ws = text.split()
        i = r.randrange(len(ws))
        ws[i] = f"<a href='/x'>{ws[i]}</a>" if r.random() < 0.6 else f"<b>{ws[i]}</b>"
        text = " ".join(ws)
    return text


def _links(r: random.Random, n: int, tag: str = "li") -> str:
    return "".join(f"<{tag}><a href='/{i}'>{_sentence(r, 1, 6).rstrip('.?')}</a></{tag}>" for i in range(n))


def synthetic_page(r: random.Random, mark: str) -> str:
    """One page; what is not main text has the attribute ``mark`` on the outermost node of it."""
    names = lambda g: r.choice(WORDS[g].split())
    att = lambda g, p=0.8: f' {r.choice(("class", "id", "class"))}="{names(g)}{r.choice(("", "-box", " wrap", "_1"))}"' if r.random() < p else ""

    def bad(tag: str, g: str, inner: str, p: float = 0.9) -> str:
        return f"<{tag}{att(g, p)} {mark}>{inner}</{tag}>"

    def nav() -> str:
        inner = f"<ul>{_links(r, r.randint(2, 9))}</ul>" if r.random() < 0.7 else _links(r, r.randint(2, 8), r.choice(("p", "div", "span")))
        return bad("nav", "nav", inner, 0.3) if r.random() < 0.5 else bad("div", "nav", inner) if r.random() < 0.7 else f'<div role="navigation" {mark}>{inner}</div>'

    def comments() -> str:
        one = lambda: r.choice((f"<li{att('talk', 0.5)}><b>{_sentence(r, 1, 2)}</b><p>{_para(r)}</p></li>", f"<div{att('talk')}><p>{_sentence(r, 3, 20)}</p></div>", f"<p>{_para(r)}</p>"))
        inner = f"<h{r.randint(2, 4)}>{r.randint(1, 40)} comments</h3>" + "".join(one() for _ in range(r.randint(1, 6)))
        return bad(r.choice(("div", "section", "section", "ol", "ul", "aside")), "talk", inner, 1.0)

    def side() -> str:
        inner = f"<h3>{_sentence(r, 1, 3)}</h3>" + r.choice((f"<ul>{_links(r, r.randint(2, 8))}</ul>", f"<p>{_para(r)}</p>", "".join(f"<p>{_sentence(r, 2, 9)}</p>" for _ in range(3))))
        return bad("aside", "side", inner, 0.5) if r.random() < 0.6 else bad("div", "side", inner, 1.0)

    def form() -> str:
        inner = f"<p>{_sentence(r, 2, 10)}</p><label>{_sentence(r, 1, 3)}</label><input name=q><button>go</button>"
        return f"<form{att('form', 0.5)} {mark}>{inner}</form>" if r.random() < 0.7 else bad(r.choice(("div", "section")), "form", f"<h3>{_sentence(r, 2, 6)}</h3><form>{inner}</form>", 1.0)

    def ad() -> str:
        return bad(r.choice(("div", "aside", "section", "p")), "ad", r.choice((_sentence(r, 2, 14), f"<p>{_sentence(r, 2, 16)}</p>", f"<a href='/b'>{_sentence(r, 2, 9)}</a>", _sentence(r, 1, 8) + " " + _sentence(r, 1, 8))), 1.0)

    def note() -> str:
        return bad(r.choice(("div", "section", "dialog", "p")), "note", r.choice((_sentence(r, 4, 20), f"<p>{_sentence(r, 4, 20)}</p><a href='/ok'>ok</a>")), 1.0)

    def share() -> str:
        return bad(r.choice(("div", "ul")), "share", _links(r, r.randint(2, 5)), 1.0)

    def head() -> str:
        inner = f"<p>{_sentence(r, 1, 4)}</p>" * (r.random() < 0.6) + (f"<h1>{_sentence(r, 1, 3)}</h1>" if r.random() < 0.3 else "") + (f"<ul>{_links(r, 4)}</ul>" if r.random() < 0.4 else "") or _sentence(r, 1, 4)
        return bad("header", "head", inner, 0.4) if r.random() < 0.6 else bad("div", "head", inner, 1.0)

    def foot() -> str:
        inner = r.choice((f"&copy; site &middot; {_sentence(r, 3, 12)}", f"<p>&copy; {_sentence(r, 2, 8)}</p>", f"<ul>{_links(r, 5)}</ul><p>{_sentence(r, 2, 9)}</p>", f"<p>{_para(r)}</p>"))
        return bad("footer", "foot", inner, 0.3) if r.random() < 0.6 else bad("div", "foot", inner, 1.0)

    body = [f"<h{r.choice((1, 1, 2))}>{_sentence(r, 1, 12)}</h1>"] * (r.random() < 0.9)
    for _ in range(r.choice((0, 1, 1, 2, 4, 7, 12, 25))):
        x = r.random()
        if x < 0.66:
            body.append(r.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p class='text'>{}</p>", "<div>{}</div>")).format(_para(r)))
        elif x < 0.74:
            body.append(f"<h{r.randint(2, 4)}>{_sentence(r, 1, 7)}</h3>")
        elif x < 0.80:
            body.append(f"<{r.choice(('ul', 'ol'))}>" + "".join(f"<li>{_sentence(r, 1, 14)}{'</li>' if r.random() < 0.8 else ''}" for _ in range(r.randint(1, 7))) + "</ul></ol>")
        elif x < 0.84:
            body.append(f"<blockquote>{r.choice(('<p>{}</p>', '{}')).format(_para(r))}</blockquote>")
        elif x < 0.87:
            body.append(f"<pre>{_sentence(r, 2, 14)}\n  {_sentence(r, 1, 9)}</pre>")
        elif x < 0.90:
            body.append("<table>" + "".join(f"<tr><td>{_sentence(r, 1, 3)}</td><td>{_sentence(r, 1, 5)}</td></tr>" for _ in range(r.randint(1, 5))) + "</table>")
        elif x < 0.92:
            body.append(f"<figure><img src=x><figcaption>{_sentence(r, 2, 10)}</figcaption></figure>")
        else:
            body.append(r.choice((ad, ad, form, share, note, side))())
    inside = "".join(body)
    if r.random() < 0.12:
        inside += comments()
    kind = r.random()
    if kind < 0.55:
        main = f"<article{att('main', 0.3)}>{inside}</article>"
    elif kind < 0.70:
        main = f"<main{att('main', 0.3)}>{inside}</main>"
    elif kind < 0.94:
        main = f"<div{att('main', 1.0)}>{inside}</div>"
    else:
        main = f"<div>{inside}</div>"
    if r.random() < 0.2:
        main = f"<main>{main}</main>" if "<main" not in main else f"<div class='container'>{main}</div>"
    before = [f() for f in (head, nav, note, ad, form, side) if r.random() < 0.42]
    after = [f() for f in (comments, side, share, ad, form, note) if r.random() < 0.35]
    r.shuffle(before)
    r.shuffle(after)
    page = "".join(before) + main + "".join(after) + foot() * (r.random() < 0.85)
    if r.random() < 0.2:
        page = f"<div id='page'>{page}</div>"
    page = f"<html><head><title>{_sentence(r, 1, 5)}</title></head><body>{page}</body></html>"
    return page[: r.randrange(len(page) // 2, len(page))] if r.random() < 0.1 else page


def synthetic_pages(n: int, seed: int, mark: str = "data-cut") -> list[Page]:
    r = random.Random(seed)
    return [Page(synthetic_page(r, mark), mark) for _ in range(n)]


def _labels(pages: list[Page], parent: np.ndarray, begin: np.ndarray) -> np.ndarray:
    y = np.concatenate([p.y for p in pages]).astype(float)
    for v in range(len(y)):  # parents stand before their children
        if parent[v] >= 0 and y[parent[v]] == 0:
            y[v] = 0
    return y


def model(pages: int = 1200, seed: int = 20) -> Boosted:
    """The trained trees, made once in a process."""
    cache = builtins.__dict__.setdefault("_linkwork_html_model", {})
    if (pages, seed) not in cache:
        made = synthetic_pages(pages, seed)
        x, parent, begin = features(made)
        length = np.expm1(x[:, 2])
        cache[pages, seed] = Boosted().fit(x, _labels(made, parent, begin), np.where(length > 0, 1.0, 0.1) * (parent >= 0))
    return cache[pages, seed]


# --- batches ----------------------------------------------------------------


def extract_texts(sources: list[str | None], trees: Boosted) -> list[str]:
    """Main text of each page."""
    pages = [Page(s or "") for s in sources]
    x, parent, begin = features(pages)
    depth = x[:, 0].astype(np.int64)
    own = np.expm1(x[:, 1])
    kept = decode(trees.odds(x), parent, depth, np.sqrt(own) + 0.5)
    out = []
    for p, at in zip(pages, begin.tolist(), strict=False):
        out.append("\n".join(t for v, t in p.runs if v and kept[at + v]))
    return out


def extract(pages: DataFrame, batch: int = 400) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    spark = prepare(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    shared = spark.sparkContext.broadcast(model())
    schema = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, batch):
                c = b.slice(i, batch)
                text = pa.array(extract_texts(c.column("html").to_pylist(), shared.value), pa.string())
                yield pa.RecordBatch.from_arrays([c.column("page_id"), c.column("url"), text, pc.utf8_length(text).cast(pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
