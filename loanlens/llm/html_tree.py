"""Main-text extraction with a tree-structured graphical model (op 1).

A tolerant tokenizer turns a page into its tree of block elements; each run of
inline content is a text leaf. Every node is a binary variable, content or
boilerplate. Unary potentials come from the node's tag, names (class, id,
role), link share, length and punctuation, and from what needs no names: how
much of the page's text and prose a block holds, next to its largest sibling
too, where on the page it begins, and how often its shape repeats among its
siblings (as list entries and reader comments do). A 2x2 potential couples a
child to its parent (one table for elements, one for text leaves). Sum-product messages
go up from the leaves and down from the roots, which gives exact marginals on
a tree; leaves whose content marginal reaches one half are the main text. The
weights maximise the exact likelihood of labelled pages, with the same message
passing giving the expected counts. The labelled pages are composed here from
common page parts (:func:`labelled_pages`), each part carrying its label, in
several layouts; a good part of them has hashed, foreign or no names, so that
structure alone must tell.

Scale: training reads a fixed number of labelled pages on the driver and ships
a few hundred weights; extraction is one narrow pass, message passing runs
level by level over all pages of a batch at once. No shuffle, no hot key.

Text rules: character references are decoded, white space inside a block
becomes one space (``<br>`` counts as white space), blocks are trimmed, empty
ones dropped, the rest joined in page order by a line feed.

Edge cases: null, empty or cut-off html gives what it holds, possibly the
empty text; stray and missing end tags follow HTML's implied ends; repeated
rows repeat their result; null ids and urls stay null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup up to their own end tag.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements that never hold main text.
_SILENT = frozenset("head script style title textarea noscript template svg math iframe object canvas audio video "
                    "noembed noframes xmp select button dialog".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var output wbr img br".split())
_ENDS_P = frozenset("address article aside blockquote center details dir div dl dd dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary "
                    "table ul".split())
#: An opening tag ends the last open element of the first set, not looking beyond the second.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, {"body"}),
}
_P_SCOPE = frozenset("table td th caption button object".split())


@dataclass
class Tree:
    """Nodes of one page in document order; node 0 is the root."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    attrs: list[str] = field(default_factory=lambda: [""])
    text: list[str | None] = field(default_factory=lambda: [None])
    link: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int, tag: str, attrs: str, text: str | None, link: int) -> int:
        for store, value in zip((self.parent, self.tag, self.attrs, self.text, self.link),
                                (parent, tag, attrs, text, link)):
            store.append(value)
        return len(self.parent) - 1


def parse(page: str) -> Tree:
    """Block tree of a page with its inline runs as ``#text`` leaves."""
    tree = Tree()
    stack: list[tuple[str, int]] = [("#root", 0)]  # (tag, block node it belongs to)
    run: list[str] = []
    linked = silent = links_open = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                tree.add(stack[-1][1], "#text", "", text, min(linked, len(text)))
            run.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal silent, links_open
        if any(tag not in _INLINE for tag, _ in stack[depth:]):
            flush()
        for tag, _ in stack[depth:]:
            silent -= tag in _SILENT
            links_open -= tag == "a"
        del stack[depth:]

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not silent:
            piece = html_lib.unescape(piece) if "&" in piece else piece
            run.append(piece)
            if links_open:
                linked += len(piece.strip())

    def nearest(names, stop) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stop:
                return 0
        return 0

    at = 0
    while m := _TOKEN.search(page, at):
        text(page[at: m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if tag in _INLINE:
                stop = {t for t, _ in stack if t not in _INLINE}
                if k := nearest((tag,), stop):
                    pop_to(k)
            elif k := nearest((tag,), ()):
                pop_to(k)
            elif tag == "p":
                flush()
            continue
        if tag in _ENDS_P and (k := nearest(("p",), _P_SCOPE)):
            pop_to(k)
        if tag in _IMPLIED and (k := nearest(*_IMPLIED[tag])):
            pop_to(k)
        if tag in ("br", "wbr", "img"):
            if tag == "br":
                text(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _INLINE:
            stack.append((tag, stack[-1][1]))
            links_open += tag == "a"
        else:
            flush()
            node = stack[-1][1]
            if not silent and tag not in _SILENT:
                node = tree.add(node, tag, attrs, None, 0)
            stack.append((tag, node))
            silent += tag in _SILENT
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            pop_to(len(stack) - 1)
    text(page[at:])
    pop_to(1)
    flush()
    return tree


def names_in(attrs: str) -> list[str]:
    """Distinct lower-case words of class, id and role, however many; those a model has not seen cost nothing."""
    if "=" not in attrs:
        return []
    found = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs))
    return list(dict.fromkeys(w.lower() for w in _NAME_PART.findall(found)))


def _bucket(n: int) -> int:
    return min(n.bit_length(), 11)


#: Characters from which a text that ends a sentence counts as prose.
_PROSE = 60


def _few(n: int) -> int:
    return n if n < 3 else 3 if n < 6 else 6


def node_features(tree: Tree) -> list[list[str]]:
    """Feature names per node."""
    n = len(tree.parent)
    size, linked, prose, begins = [0] * n, [0] * n, [0] * n, [0] * n
    below: list[list[int]] = [[] for _ in range(n)]
    at = 0
    for v in range(n):
        begins[v] = at
        if tree.text[v] is not None:
            at += len(tree.text[v])
        if tree.parent[v] >= 0:
            below[tree.parent[v]].append(v)
    whole = max(at, 1)
    for v in range(n - 1, -1, -1):
        text = tree.text[v]
        if text is not None:
            size[v], linked[v] = len(text), tree.link[v]
            prose[v] = int(size[v] >= _PROSE and text[-1] in '.!?"\u201d\u3002' and 3 * linked[v] < size[v])
        if tree.parent[v] >= 0:
            for count in (size, linked, prose):
                count[tree.parent[v]] += count[v]
    # shape of an element: its tag and those of its first children; paragraphs side by side are no repetition
    shape = [(tree.tag[v], *[tree.tag[c] for c in below[v][:3]]) for v in range(n)]
    repeats, beside = [0] * n, [False] * n
    for v in range(n):
        same: dict[tuple, int] = {}
        for c in below[v]:
            if tree.text[c] is None and tree.tag[c] != "p":
                same[shape[c]] = same.get(shape[c], 0) + 1
        most = max((size[c] for c in below[v]), default=0)
        for c in below[v]:
            repeats[c] = same.get(shape[c], 1) if tree.text[c] is None and tree.tag[c] != "p" else 0
            beside[c] = size[c] == most
    out = []
    for v in range(n):
        share = -1 if not size[v] else 10 * linked[v] // size[v] // 3
        text = tree.text[v]
        place = 4 * begins[v] // whole
        if text is None:
            held = 4 * size[v] // whole
            out.append([f"tag {tree.tag[v]}", f"links {share}", f"only links {share == 3} {held}", f"prose {_few(prose[v])} {held}",
                        f"largest {beside[v]} {_few(prose[v])}", f"repeats {_few(repeats[v])} {share > 0}",
                        f"place {place} {prose[v] > 0}", *(f"name {w}" for w in names_in(tree.attrs[v]))])
        else:
            low = text.lower()
            legal = "©" in text or "copyright" in low or "all rights reserved" in low or "cookies" in low
            p = tree.parent[v]
            out.append([f"text in {tree.tag[p]}", f"text links {share}", f"text size {_bucket(size[v])}",
                        f"text stop {text[-1] in '.!?'}", f"text legal {legal}", f"text prose {prose[v]} {_few(prose[p])}",
                        f"text repeats {_few(repeats[p])}", f"text only links {share == 3} {tree.tag[p]}"])
    return out


@dataclass
class Forest:
    """Trees of many pages as arrays, grouped by depth."""

    parent: np.ndarray
    is_text: np.ndarray
    levels: list[np.ndarray]     # nodes by depth, roots first
    feature: np.ndarray          # feature number of each (node, feature) entry
    feature_node: np.ndarray


def forest_of(trees: list[Tree], vocabulary: dict[str, int], grow: bool = False) -> Forest:
    parent, is_text, depth, feature, feature_node, base = [], [], [], [], [], 0
    for tree in trees:
        for v, p in enumerate(tree.parent):
            parent.append(p + base if p >= 0 else -1)
            depth.append(depth[p + base] + 1 if p >= 0 else 0)
        is_text += [t is not None for t in tree.text]
        for v, names in enumerate(node_features(tree)):
            for name in names:
                k = vocabulary.setdefault(name, len(vocabulary)) if grow else vocabulary.get(name)
                if k is not None:
                    feature.append(k)
                    feature_node.append(base + v)
        base += len(tree.parent)
    d = np.array(depth, np.int64)
    order = np.argsort(d, kind="stable")
    cuts = np.searchsorted(d[order], np.arange(1, (d.max() if len(d) else 0) + 1))
    return Forest(np.array(parent, np.int64), np.array(is_text, bool), np.split(order, cuts),
                  np.array(feature, np.int64), np.array(feature_node, np.int64))


def sum_product(forest: Forest, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Content marginals per node, and pair marginals (node, parent state, own state).

    ``unary`` is the log potential of content against boilerplate; ``pair`` is
    indexed (leaf kind, parent state, own state).
    """
    n = len(forest.parent)
    inner = np.zeros((n, 2))
    inner[:, 1] = unary
    up = np.zeros((n, 2))
    kind = forest.is_text.astype(np.int64)
    for nodes in reversed(forest.levels[1:]):                      # leaves to roots
        up[nodes] = np.logaddexp.reduce(pair[kind[nodes]] + inner[nodes][:, None, :], axis=2)
        np.add.at(inner, forest.parent[nodes], up[nodes])
    belief = inner.copy()
    joint = np.zeros((n, 2, 2))
    for nodes in forest.levels[1:]:                                # roots to leaves
        outer = (belief[forest.parent[nodes]] - up[nodes])[:, :, None] + pair[kind[nodes]]
        belief[nodes] = inner[nodes] + np.logaddexp.reduce(outer, axis=1)
        both = outer + inner[nodes][:, None, :]
        joint[nodes] = np.exp(both - np.logaddexp.reduce(both, axis=(1, 2), keepdims=True))
    content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))
    return content, joint


@dataclass(frozen=True)
class TreeModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    pair: np.ndarray

    def marginals(self, trees: list[Tree]) -> tuple[Forest, np.ndarray]:
        forest = forest_of(trees, self.vocabulary)
        unary = np.bincount(forest.feature_node, weights=self.weights[forest.feature], minlength=len(forest.parent))
        return forest, sum_product(forest, unary, self.pair)[0]


def train(trees: list[Tree], states: list[list[int]], rounds: int = 200, rate: float = 0.1,
          shrink: float = 0.008) -> TreeModel:
    """Maximum likelihood with an L2 penalty by Adam steps on exact gradients."""
    vocabulary: dict[str, int] = {}
    forest = forest_of(trees, vocabulary, grow=True)
    y = np.concatenate([np.array(s) for s in states])
    kind, child = forest.is_text.astype(np.int64), np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind[child], y[forest.parent[child]], y[child]), 1)
    w = np.zeros(len(vocabulary) + 8)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        unary = np.bincount(forest.feature_node, weights=w[8:][forest.feature], minlength=len(y))
        content, joint = sum_product(forest, unary, w[:8].reshape(2, 2, 2))
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, kind[child], joint[child])
        slope = np.r_[(seen - expected).ravel(), np.bincount(
            forest.feature, weights=(y - content)[forest.feature_node], minlength=len(vocabulary))] - shrink * w * 10
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        w += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return TreeModel(vocabulary, w[8:], w[:8].reshape(2, 2, 2))


# ------------------------------------------------------------- labelled pages

# Usual names and tags of page parts, by label.
_MAIN_NAMES = ("content main-content article article-body post post-content entry entry-content story story-body "
               "page-content text body-text main maincontent content-wrapper blog-post news-article").split()
_ASIDE_NAMES = {
    "nav": "nav navbar navigation menu main-menu site-nav breadcrumb breadcrumbs topnav submenu pagination pager toc".split(),
    "header": "header site-header masthead topbar page-header banner branding logo".split(),
    "footer": "footer site-footer page-footer bottom copyright legal colophon credits".split(),
    "aside": "sidebar side-bar aside rail right-rail widget widgets related related-posts recommended more-stories "
             "trending popular tags author-box".split(),
    "notice": "cookie cookie-notice cookie-banner consent gdpr notice alert popup modal overlay newsletter subscribe "
              "signup paywall announcement message warning".split(),
    "ad": "ad ads advert advertisement ad-slot adsbygoogle sponsor sponsored promo promotion banner-ad commercial".split(),
    "form": "form search search-form login contact-form newsletter-form comment-form".split(),
    "comments": "comments comment comment-list reader-comments discussion responses replies reply disqus feedback".split(),
    "share": "share social social-share sharing toolbar buttons meta-links".split(),
}
_ASIDE_TAGS = {"nav": "nav nav div ul".split(), "header": "header header div".split(),
               "footer": "footer footer div".split(), "aside": "aside aside div section".split(),
               "notice": "div section p".split(), "ad": "div div aside section".split(), "form": ["form"],
               "comments": "section div ol".split(), "share": "div ul".split()}


class _Composer:
    """Composes one labelled page; ``data-y`` carries the label of a part."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        roll = self.r.random()
        # usual names, hashed ones, unknown words, or none at all
        self.naming = "usual" if roll < 0.6 else "hashed" if roll < 0.74 else "foreign" if roll < 0.84 else "none"
        self.plain = self.naming != "usual" and self.r.random() < 0.7      # divs in place of telling tags
        self.dull = False
        self.of = {}

    def named(self, word: str, key: str = "class") -> str:
        """An attribute with a name, as this page writes names; equal words give equal ones."""
        if self.naming == "none":
            return ""
        if self.naming != "usual":
            long = self.naming == "foreign"
            letters = "aeiounrstlkmdgz" if long else "abcdefghijklmnopqrstuvwxyz0123456789"
            word = self.of.setdefault(word, "".join(self.r.choice(letters) for _ in range(self.r.randint(5, 14) if long else 7)))
            word = word if long else "css-" + word
        return f" {key}='{word}'"

    def tag(self, tag: str) -> str:
        return "div" if self.plain and tag in ("nav", "header", "footer", "aside", "section", "article", "main") else tag

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = ["".join(r.choice("aeioulnrstdmkpv") for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high))]
        out[0] = out[0].capitalize()
        return " ".join(out)

    def prose(self, low: int = 4, high: int = 70) -> str:
        if self.dull and low < 9:      # articles of scraps: single words, repeated words, rows of marks
            return self.r.choice((self.words(1, 2) + ".", (self.words(1, 1) + " ") * self.r.randint(2, 60),
                                  self.r.choice((" | ", "*** ", " ### ")).join([self.words(1, 1)] * self.r.randint(2, 20)),
                                  self.words(3, 14), self.words(3, 14) + "."))
        return self.words(low, high) + self.r.choice(["."] * 8 + ["!", "", " |", "***"])

    def links(self, n: int, item: str = "li") -> str:
        return "".join(f"<{item}><a href='/x'>{self.words(1, 4)}</a></{item}>" for _ in range(n))

    def aside(self, kind: str) -> str:
        r = self.r
        tag = self.tag(r.choice(_ASIDE_TAGS[kind]))
        name = (self.named(r.choice(_ASIDE_NAMES[kind]), r.choice(("class", "class", "id")))
                if tag in ("div", "section", "p", "ol", "ul") or r.random() < 0.5 else "")
        if tag in ("ul", "ol") or kind in ("nav", "share"):
            inner = self.links(r.randint(2, 9)) if tag in ("ul", "ol") else f"<ul>{self.links(r.randint(2, 9))}</ul>"
        elif kind == "form":
            inner = f"<label>{self.words(1, 3)}</label><input><p>{self.words(2, 9)}</p>"
        elif kind == "comments" and self.naming == "usual" and r.random() < 0.4:
            inner = "".join(f"<p>{self.prose(3, 50)}</p>" for _ in range(r.randint(1, 6)))
        elif kind == "comments":
            inner = r.choice(("", f"<h3>{self.words(1, 3)}</h3>")) + "".join(
                f"<div{self.named('comment')}>{by}<p>{self.prose(3, 50)}</p></div>"
                for by in [r.choice(("", f"<b>{self.words(1, 2)}</b>", f"<h4>{self.words(1, 2)}</h4>"))]
                for _ in range(r.randint(1, 6) if self.naming == "usual" else r.randint(2, 6)))
        elif kind == "header":
            inner = r.choice((f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 6)}</p>", f"<a href='/'>{self.words(1, 2)}</a>"))
            inner += r.choice(("", f"<ul>{self.links(4)}</ul>"))
        elif kind == "footer":
            inner = r.choice((f"&copy; {self.words(1, 4)}", f"<p>Copyright {self.words(2, 8)}</p>", self.prose(3, 25)))
            inner += r.choice(("", f"<ul>{self.links(4)}</ul>"))
        else:
            inner = r.choice((self.prose(3, 30), f"<p>{self.prose(3, 40)}</p>", f"<h3>{self.words(1, 4)}</h3><ul>{self.links(4)}</ul>",
                              f"<h4>{self.words(1, 4)}</h4><p>{self.prose(5, 30)}</p>"))
        return f"<{tag}{name} data-y=0>{inner}</{tag}>"

    def main(self) -> str:
        r, out = self.r, []
        self.dull = r.random() < 0.3
        para = "div" if self.plain and r.random() < 0.4 else "p"
        if r.random() < 0.85:
            out.append(r.choice((f"<h1>{self.words(2, 9)}</h1>", f"<header><h1>{self.words(2, 9)}</h1></header>")
                                if r.random() < 0.3 else (f"<h1>{self.words(2, 9)}</h1>",)))
        for _ in range(r.randint(1, 9)):
            roll = r.random()
            if roll < 0.66:
                out.append(f"<{para}>{self.prose(1, 90)}</{para}>" if roll < 0.5 or para == "div" else f"<p><b>{self.prose(1, 40)}<br><p>{self.prose()}</p>")
            elif roll < 0.74:
                out.append(f"<h2>{self.words(1, 6)}</h2>")
            elif roll < 0.82:
                out.append("<ul>" + "".join(f"<li>{self.prose(2, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif roll < 0.86:
                out.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif roll < 0.89:
                out.append(f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>")
            elif roll < 0.91:
                out.append(f"<pre>{self.words(3, 20)}</pre>")
            elif roll < 0.94:
                out.append(f"<figure><figcaption>{self.words(3, 12)}</figcaption></figure>")
            elif roll < 0.97:
                out.append(f"<div>{self.prose()}</div>")
            else:
                out.append(f"<p>{self.words(3, 20)} <a href='/y'>{self.words(1, 5)}</a> {self.prose()}</p>")
            if r.random() < 0.12:
                out.append(self.aside(r.choice(("ad", "aside", "share", "notice", "form"))))
        if r.random() < 0.2:
            out.append(self.aside("comments"))
        inner, self.dull = "".join(out), False
        name = r.choice(_MAIN_NAMES)
        article, main, section = (self.tag(t) for t in ("article", "main", "section"))
        shell = r.choice((f"<{article} data-y=1>{{}}</{article}>", f"<{article} data-y=1>{{}}</{article}>",
                          f"<{main} data-y=1>{{}}</{main}>", f"<div{self.named(name)} data-y=1>{{}}</div>",
                          f"<div{self.named(name, 'id')} data-y=1>{{}}</div>",
                          f"<{section}{self.named(name)} data-y=1>{{}}</{section}>", "<div data-y=1>{}</div>", "{}",
                          f"<{main} data-y=1><{article} data-y=1>{{}}</{article}></{main}>"))
        return shell.replace("{}", inner)

    def page(self) -> str:
        r = self.r
        some = lambda p, *kinds: "".join(self.aside(k) for k in kinds if r.random() < p)
        top = some(0.5, "notice", "header", "nav") + some(0.3, "ad", "form")
        middle = self.main()
        side = some(0.4, "aside", "ad")
        end = some(0.35, "comments", "share", "aside") + some(0.7, "footer")
        layouts = [f"{top}{middle}{side}{end}", f"{top}<div{self.named('wrapper')} data-y=1>{middle}{side}</div>{end}",
                   f"{top}<div{self.named('page', 'id')} data-y=1><div data-y=1>{side}{middle}</div>{end}</div>"]
        if r.random() < 0.15:      # table layout
            lines = "<br>".join(f"<a href='/x'>{self.words(1, 3)}</a>" for _ in range(r.randint(2, 9)))
            menu = f"<td data-y=0>{r.choice((self.links(r.randint(3, 9), 'p'), lines, lines, self.links(r.randint(2, 9), 'div')))}</td>"
            cells = r.choice((f"{menu}<td data-y=1>{middle}</td>", f"<td data-y=1>{middle}</td>{menu}"))
            layouts = [f"{top}<table data-y=1><tr data-y=1>{cells}</tr></table>{end}"]
        body = r.choice(layouts)
        return f"<html><head><title>{self.words(1, 6)}</title></head><body data-y=1>{body}</body></html>"


def labelled_pages(count: int = 1000, seed: int = 1) -> list[str]:
    """Composed pages; the nearest ``data-y`` around a node is its label."""
    return [_Composer(seed * 100_003 + k).page() for k in range(count)]


def labels_of(tree: Tree) -> list[int]:
    out: list[int] = []
    for p, attrs in zip(tree.parent, tree.attrs):
        own = re.search(r"data-y=([01])", attrs)
        out.append(int(own[1]) if own else (out[p] if p >= 0 else 1))
    return out


@lru_cache(maxsize=2)
def default_model(count: int = 1000) -> TreeModel:
    trees = [parse(p) for p in labelled_pages(count)]
    return train(trees, [labels_of(t) for t in trees])


# ------------------------------------------------------------------ extraction

def extract(pages: list[str | None], model: TreeModel) -> list[list[str]]:
    """Main-text blocks of each page."""
    trees = [parse(p or "") for p in pages]
    forest, content = model.marginals(trees)
    out, base = [], 0
    for tree in trees:
        out.append([t for k, t in enumerate(tree.text) if t is not None and content[base + k] >= 0.5])
        base += len(tree.parent)
    return out


def _steps(html: pa.Array, pages: int, most_bytes: int) -> Iterator[tuple[int, int]]:
    """(first, count) of runs of pages with at most ``most_bytes`` of html together (a larger page is a run of its own)."""
    sizes = pc.fill_null(pc.binary_length(html), 0).to_pylist()
    first = held = 0
    for k, n in enumerate(sizes):
        if k > first and (held + n > most_bytes or k - first == pages):
            yield first, k - first
            first, held = k, 0
        held += n
    if len(sizes) > first:
        yield first, len(sizes) - first


def _extract_pass(model: TreeModel, batch_pages: int = 256, batch_bytes: int = 8 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count in _steps(batch.column(2), batch_pages, batch_bytes):
                part = batch.slice(first, count)
                texts = ["\n".join(b) for b in extract(part.column(2).to_pylist(), model)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                       pa.array([len(t) for t in texts], pa.int64())],
                                      names=["page_id", "url", "text", "n_chars"])
    return run


def main_text(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    ship_package(pages.sparkSession)
    table = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    return table.mapInArrow(_extract_pass(model or default_model()),
                            "page_id long, url string, text string, n_chars long")
