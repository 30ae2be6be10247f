"""Main-text extraction by a tree-structured graphical model over the DOM.

Nodes are a page's block elements that hold text, and their runs of text. Each node is content or not: a node
potential weighs its features, a potential on every parent-child link says how alike the two are, by the kind of
child. Sum-product messages go up and down the tree once and give exact marginals; runs whose content marginal is at
least one half make the text. The weights are trained by gradient ascent on the likelihood of labelled
pages (:func:`labelled_pages`: pages of many layouts whose blocks are marked while they are written). All pages of a batch
form one forest, so messages of a level of depth are array operations.

Defined results: null and empty pages, and pages without content, give the empty string; character references are
decoded; white space inside a block becomes one space; ``br`` is white space; unclosed and stray
tags are taken as browsers take them where that decides a block's extent (``html``, ``head`` and ``body`` may be left out, a slash closes
an ``svg`` or ``math`` element, their unclosed forms end at the next element of a page); repeated rows give equal texts; other
columns are kept and their names may be any.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 256  # pages of a forest
#: Elements inside a block, without text of their own, and without an end.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var img br wbr".split())
SILENT = frozenset("script style noscript template iframe object svg math canvas audio video title select textarea".split())
FOREIGN = frozenset(("svg", "math"))  # in these a slash does close an element
#: Elements in foreign ones whose content is that of a page again, and (fixed values: the HTML standard) the opening tags that
#: end foreign elements outside of those.
INTEGRATION = frozenset("foreignobject desc annotation-xml".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
                     "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Elements that a part of a page seldom holds, but a page does.
LANDMARKS = frozenset("article main header footer nav aside h1".split())
#: Shares of a page's text from which on an element, with landmarks in it or without, holds the page rather than a part of it.
WIDE, WHOLE = 0.5, 0.95
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag ends if they are still open, up to the named borders.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
_KEYS = re.compile(
    r"(?P<comment>comment|repl(?:y|ies)|disqus|respond|discussion)|(?P<menu>nav|menu|breadcrumb|crumb|toc\b|pagina|pager|tabs?\b)|"
    r"(?P<foot>foot|copyright|legal|colophon)|(?P<ad>\bads?\b|advert|sponsor|promo|banner|adsense|affiliate)|"
    r"(?P<notice>cookie|consent|gdpr|notice|popup|modal|overlay|alert|paywall|toast)|"
    r"(?P<side>sidebar|side\b|aside|widget|related|recommend|popular|trending|more\b|teaser)|"
    r"(?P<form>form|search|login|subscribe|newsletter|signup|register)|(?P<share>share|social|follow|tags?\b|meta\b|byline|author)|"
    r"(?P<head>header|masthead|topbar|logo|branding|site)|(?P<main>article|content|main|post|entry|story|body|text|page)")
_BORDER = re.compile(r"(?<=[a-z])(?=[A-Z])")
_LAYOUT = re.compile(r"\b(?:has|with|without|no)[_\- ]+\w+")  # says what stands elsewhere in the page


class Page(HTMLParser):
    """Nodes of one page: parent, kind, features and text, in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.keys, self.gold = [-1], ["#root"], [()], [None]
        self.text: list[str | None] = [None]
        self.linked = [0]
        self.open = [(0, "#root")]  # (node, tag); inline elements carry their block's node
        self.run: list[str] = []
        self.links = self.run_linked = 0
        self.silent: list[str] = []  # open elements without text of the page, from the outermost
        self.feed(html)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.run).split())
        if text:
            self._add(self.open[-1][0], "#text", (), text, self.run_linked)
        self.run, self.run_linked = [], 0

    def _add(self, parent, tag, keys, text, linked, gold=None):
        self.parent.append(parent)
        self.tag.append(tag)
        self.keys.append(keys)
        self.text.append(text)
        self.linked.append(linked)
        self.gold.append(gold if gold is not None else self.gold[parent])

    def _pop(self, at: int):
        """Closes the open elements from place ``at`` on."""
        for node, tag in self.open[at:]:
            if tag == "a":
                self.links -= 1
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if self.silent and self.silent[-1] in FOREIGN and tag in BREAKOUT:
            while self.silent and self.silent[-1] in FOREIGN:
                self.silent.pop()
        if self.silent:
            if tag in SILENT or (tag in INTEGRATION and self.foreign):
                self.silent.append(tag)
            return
        if tag in SILENT:
            self.flush()
            self.silent.append(tag)
            return
        if tag in ("html", "head", "body"):  # they may be left out, so they are no nodes; their names stand at the root
            self.flush()
            if tag != "head":
                self.keys[0] = tuple(sorted({*self.keys[0], *self._named(attrs)}))
                self.gold[0] = self._marked(attrs, self.gold[0])
            return
        if tag in INLINE:
            if tag in ("br", "wbr"):
                self.run.append(" " if tag == "br" else "")
            elif tag != "img":
                self.links += tag == "a"
                self.open.append((self.open[-1][0], tag))
            return
        self.flush()
        if tag in VOID:
            return
        closing, borders = ENDS.get(tag, ({"p"}, {"button", "td", "th", "table", "#root"}))
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][1] in closing:
                self._pop(at)
                break
            if self.open[at][1] in borders or (closing == {"p"} and self.open[at][1] not in INLINE):
                break
        self._add(self.open[-1][0], tag, self._named(attrs), None, 0, self._marked(attrs, None))
        self.open.append((len(self.tag) - 1, tag))

    @staticmethod
    def _named(attrs) -> tuple:
        named = " ".join(_BORDER.sub(" ", v) for k, v in attrs if k in ("class", "id", "role", "itemprop") and v)
        return tuple(sorted({m.lastgroup for m in _KEYS.finditer(re.sub(r"[_\-\d]+", " ", _LAYOUT.sub(" ", named.lower())))})) if named else ()

    @staticmethod
    def _marked(attrs, otherwise):
        return next((v == "1" for k, v in attrs if k == "data-gold"), otherwise)

    @property
    def foreign(self) -> bool:
        return any(tag in FOREIGN for tag in self.silent)

    def handle_startendtag(self, tag, attrs):
        if tag in FOREIGN and not self.silent:
            self.flush()
        elif not (tag in FOREIGN or self.foreign) or (self.silent[-1:] and self.silent[-1] in FOREIGN and tag in BREAKOUT):
            self.handle_starttag(tag, attrs)  # a slash does not close an element in a page

    def handle_endtag(self, tag):
        if self.silent:
            if tag in self.silent:
                del self.silent[len(self.silent) - 1 - self.silent[::-1].index(tag):]
            return
        if tag in SILENT or tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][1] == tag:
                self._pop(at)
                return
            if tag in INLINE and self.open[at][1] not in INLINE:
                return

    def handle_data(self, data):
        if not self.silent:
            self.run.append(data)
            if self.links:
                self.run_linked += len(data)


_STOPS = re.compile(r"[.,;:!?。、]")


def _level(x: float, steps) -> int:
    return sum(x >= s for s in steps)


def features(page: Page):
    """The nodes that hold text: their places, parents among them, kinds of link, and names of features."""
    size = len(page.tag)
    chars, linked, stops = [0] * size, [0] * size, [0] * size
    landmarks = [False] * size  # in the element, not the element itself
    for i in range(size - 1, 0, -1):
        if page.text[i] is not None:
            chars[i], linked[i] = len(page.text[i]), min(page.linked[i], len(page.text[i]))
            stops[i] = len(_STOPS.findall(page.text[i]))
        up = page.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        stops[up] += stops[i]
        landmarks[up] |= landmarks[i] or page.tag[i] in LANDMARKS
    total = max(1, chars[0])

    def extent(i):
        if i == 0 or (landmarks[i] and chars[i] >= WIDE * total):
            return " wide"
        return " whole" if page.text[i] is None and chars[i] >= WHOLE * total else ""

    number, above = {}, {0: frozenset()}
    places, parents, kinds, names = [], [], [], []
    for i in range(size):
        if not chars[i]:
            continue
        up = page.parent[i]
        tag, keys = page.tag[i], page.keys[i]
        number[i] = len(places)
        places.append(i)
        parents.append(number[up] if up >= 0 else -1)
        kinds.append(0 if tag == "#text" else 1 if tag in ("p", "h1", "h2", "h3", "h4", "li", "blockquote", "pre", "td") else 2)
        if up >= 0:
            wide = extent(up)
            above[i] = above[up] | {f"in {page.tag[up]}{wide}"} | {f"under {k}{wide}" for k in page.keys[up]}
        wide = extent(i)
        density = linked[i] / chars[i]
        leaf = "leaf " if tag == "#text" else "node "
        own = [f"{leaf}tag {page.tag[up] if tag == '#text' and up >= 0 else tag}{wide}",
               f"{leaf}chars {_level(chars[i], (15, 40, 80, 160, 400, 1200))}",
               f"{leaf}links {_level(density, (0.01, 0.2, 0.5, 0.9))}",
               f"{leaf}stops {_level(stops[i] / chars[i], (0.001, 0.008, 0.015, 0.03))}",
               f"{leaf}share {_level(chars[i] / total, (0.02, 0.1, 0.3, 0.6, 0.9))}", leaf]
        own += [f"key {k}{wide}" for k in keys] or ["no key"]
        own += above[i]
        names.append(own)
    return places, parents, kinds, names


KINDS = 3


def marginals(parents: np.ndarray, kinds: np.ndarray, theta: np.ndarray, links: np.ndarray):
    """Content marginals of every node, those of every link (nodes, 2, 2), and the log-partition, by sum-product messages.

    ``theta``: weight of content for each node; ``links``: (kinds, 2, 2) weights by parent's and child's state.
    """
    n = len(parents)
    depth = np.zeros(n, np.int64)
    for i in range(n):  # parents stand before their children
        if parents[i] >= 0:
            depth[i] = depth[parents[i]] + 1
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if n else []
    node = np.stack([np.zeros(n), theta], 1)
    below = node.copy()  # own potential and all messages from children
    up = np.zeros((n, 2))
    for level in levels[:0:-1]:
        pair = links[kinds[level]] + below[level][:, None, :]
        up[level] = np.logaddexp(pair[:, :, 0], pair[:, :, 1])
        np.add.at(below, parents[level], up[level])
    belief = below.copy()
    pairs = np.zeros((n, 2, 2))
    for level in levels[1:]:
        outside = belief[parents[level]] - up[level]  # the parent without this child
        pair = outside[:, :, None] + links[kinds[level]] + below[level][:, None, :]
        top = pair.max((1, 2), keepdims=True)
        pair = np.exp(pair - top)
        pairs[level] = pair / pair.sum((1, 2), keepdims=True)
        message = outside[:, :, None] + links[kinds[level]]
        belief[level] = below[level] + np.logaddexp(message[:, 0], message[:, 1])
    roots = levels[0] if n else np.zeros(0, np.int64)
    partition = float(np.logaddexp(belief[roots, 0], belief[roots, 1]).sum())
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), pairs, partition


class Model:
    """Weights of features and of links."""

    def __init__(self, known: dict[str, int], weights: np.ndarray, links: np.ndarray):
        self.known, self.weights, self.links = known, weights, links

    def forest(self, pages: list[Page]):
        get = self.known.get
        parents, kinds, owner, feature, spots = [], [], [], [], []
        for p, page in enumerate(pages):
            base = len(parents)
            places, up, kind, names = features(page)
            parents += [base + u if u >= 0 else -1 for u in up]
            kinds += kind
            spots += [(p, i) for i in places]
            for at, own in enumerate(names):
                for name in own:
                    f = get(name)
                    if f is not None:
                        owner.append(base + at)
                        feature.append(f)
        return (np.array(parents, np.int64), np.array(kinds, np.int64), np.array(owner, np.int64),
                np.array(feature, np.int64), spots)

    def content(self, html: list[str | None]) -> list[list[str]]:
        """The content blocks of each page, in page order."""
        pages = [Page(h or "") for h in html]
        parents, kinds, owner, feature, spots = self.forest(pages)
        theta = np.bincount(owner, self.weights[feature], len(parents))
        belief = marginals(parents, kinds, theta, self.links)[0]
        out: list[list[str]] = [[] for _ in pages]
        for at in np.flatnonzero((belief >= 0.5) & (kinds == 0)):
            p, i = spots[at]
            out[p].append(pages[p].text[i])
        return out


def train(pages: list[str], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Weights that make the marks (``data-gold``) of labelled pages likely."""
    parsed = [Page(p) for p in pages]
    counts: dict[str, int] = {}
    truth = []
    for page in parsed:
        places, _, _, names = features(page)
        content = [0.0] * len(page.tag)
        size = [0.0] * len(page.tag)
        for i in range(len(page.tag) - 1, 0, -1):
            if page.text[i] is not None:
                size[i] = len(page.text[i])
                content[i] = size[i] * bool(page.gold[i])
            content[page.parent[i]] += content[i]
            size[page.parent[i]] += size[i]
        truth += [content[i] > 0.5 * size[i] for i in places]
        for own in names:
            for name in own:
                counts[name] = counts.get(name, 0) + 1
    known = {n: i for i, n in enumerate(sorted(n for n, c in counts.items() if c >= 5))}
    model = Model(known, np.zeros(len(known)), np.zeros((KINDS, 2, 2)))
    parents, kinds, owner, feature, _ = model.forest(parsed)
    y = np.array(truth, float)
    state = y.astype(np.int64)
    child = parents >= 0
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (kinds[child], state[parents[child]], state[child]), 1)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.links)]
    scale = 1 / max(1, len(parsed))
    for step in range(1, rounds + 1):
        theta = np.bincount(owner, model.weights[feature], len(parents))
        belief, pairs, _ = marginals(parents, kinds, theta, model.links)
        expected = np.zeros((KINDS, 2, 2))
        np.add.at(expected, kinds[child], pairs[child])
        grads = (np.bincount(feature, (y - belief)[owner], len(known)) * scale - decay * model.weights,
                 (seen - expected) * scale - decay * model.links)
        for x, g, (m, v) in zip((model.weights, model.links), grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return model


def labelled_pages(count: int = 400, seed: int = 11) -> list[str]:
    """Pages of many layouts with invented words; what belongs to the article is marked ``data-gold="1"``."""
    rng = random.Random(seed)
    pick = rng.choice
    sound = ["ba", "ti", "on", "re", "la", "mer", "so", "ni", "dor", "vel", "ka", "u", "shi", "ex"]
    word = lambda: "".join(pick(sound) for _ in range(rng.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: phrase(3, 16).capitalize() + pick([".", ".", ".", "!", "?", ", " + phrase(2, 8) + ".", "!!", " ***", ""])
    prose = lambda a, b: escape(" ".join(sentence() for _ in range(rng.randint(a, b))))
    link = lambda: f'<a href="/{word()}">{phrase(1, 3)}</a>'

    def links(tag, extra="", a=3, b=9):
        return f"<{tag}{extra}><ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(a, b))) + f"</ul></{tag}>"

    def named(*names):
        return f' {pick(["class", "class", "id"])}="{pick(names)}"' if rng.random() < 0.85 else ""

    def menu():
        return pick([lambda: links("nav", named("nav", "main-menu", "")), lambda: links("div", f' class="{pick(["menu", "navbar", "topnav"])}"'),
                     lambda: f'<div class="breadcrumbs">{link()} &gt; {link()} &gt; {phrase(1, 3)}</div>'])()

    def header():
        inner = pick([f"<h1>{phrase(1, 3)}</h1>", f'<div class="logo">{phrase(1, 2)}</div>', f"<p>{phrase(2, 6)}</p>"]) + pick([menu(), ""])
        return pick([f"<header>{inner}</header>", f'<div{named("header", "masthead", "site-header")}>{inner}</div>'])

    def footer():
        inner = pick([f"&copy; {word()}.example &middot; {prose(1, 2)}", f"<p>{prose(1, 2)}</p>", links("div")])
        return pick([f"<footer>{inner}</footer>", f'<div class="{pick(["footer", "site-footer", "copyright"])}">{inner}</div>'])

    def side():
        inner = pick([f"<h3>{phrase(1, 3)}</h3><p>{prose(1, 3)}</p>", links("div", ' class="related"'), f"<p>{prose(1, 4)}</p>"])
        return pick([f"<aside>{inner}</aside>", f'<div class="{pick(["sidebar", "widget", "side-column", "related-posts"])}">{inner}</div>'])

    def advert():
        return f'<div class="{pick(["ad", "ads", "advert", "sponsored", "promo-box", "banner"])}">{prose(1, 4)}</div>'

    def notice():
        tag = pick(["div", "section"])
        end = tag if rng.random() < 0.9 else "div"  # some sections stay open
        return f'<{tag} class="{pick(["cookie-notice", "consent", "notice", "popup", "alert-box"])}"><p>{prose(1, 3)}</p><button>{word()}</button></{end}>'

    def form():
        return (f'<form{named("newsletter", "search-form", "login", "subscribe")}>' + pick([f"<p>{prose(1, 2)}</p>", f"<label>{phrase(1, 3)}</label>"])
                + f'<input name="q"><button>{word()}</button></form>')

    def comments():
        one = lambda: pick([f'<li class="comment"><b>{word()}</b><p>{prose(1, 5)}</p></li>', f'<div class="comment"><p>{prose(1, 5)}</p></div>',
                            f'<article class="comment"><h4>{word()}</h4><p>{prose(1, 5)}</p></article>'])
        inner = f"<h3>{phrase(1, 2)}</h3>" + "".join(one() for _ in range(rng.randint(1, 5)))
        return pick([f'<section class="comments">{inner}</section>', f'<div id="comments">{inner}</div>', f'<ol class="comment-list">{inner}</ol>'])

    def share():
        return f'<div class="{pick(["share", "social-links", "tags"])}">' + " ".join(link() for _ in range(rng.randint(2, 5))) + "</div>"

    def paragraph(gold=' data-gold="1"'):
        text = prose(1, 9)
        if rng.random() < 0.15:
            text = escape(phrase(1, 3)) + pick([".", ""])
        if rng.random() < 0.3:
            text = f"{prose(1, 2)} <a href='/{word()}'>{phrase(1, 4)}</a> {text}"
        return pick([f"<p{gold}>{text}</p>", f"<p{gold}>{text}</p>", f"<p{gold}>{text}", f"<p{gold}><b>{text}<br>", f"<p{gold}><em>{phrase(2, 5)}</em> {text}</p>"])

    def article():
        gold = ' data-gold="1"'
        parts = [pick([f"<h1{gold}>{phrase(2, 9)}</h1>", f"<h1{gold}>{prose(1, 2)}</h1>", f"<header><h1{gold}>{phrase(2, 9)}</h1></header>", ""])]
        for _ in range(pick([0, 1, 1, 2, 3, 5, 8, 14])):
            parts.append(paragraph())
            if rng.random() < 0.2:
                parts.append(pick([
                    f"<h2{gold}>{phrase(1, 6)}</h2>", f"<h3{gold}>{phrase(1, 6)}</h3>",
                    f"<ul{gold}>" + "".join(f"<li>{prose(1, 2)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>",
                    f"<blockquote{gold}><p>{prose(1, 3)}</p></blockquote>", f"<pre{gold}>{phrase(4, 20)}</pre>",
                    f"<table{gold}><tr><td>{phrase(1, 3)}<td>{phrase(1, 3)}<tr><td>{word()}<td>{word()}</table>",
                    advert(), share(), side(), form()]))
        inner = "".join(parts)
        shape = rng.random()
        if shape < 0.45:
            return f'<article{pick(["", "", named("post", "entry", "story")])}>{inner}</article>'
        if shape < 0.6:
            return f"<main>{inner}</main>"
        if shape < 0.85:
            return f'<div{pick([" class", " id"])}="{pick(["content", "main-content", "article-body", "post", "entry-content", "story-text"])}">{inner}</div>'
        if shape < 0.95:
            return f"<section>{inner}</section>"
        return f"<div>{inner}</div>"

    pages = []
    for i in range(count):
        before = [f() for f in (notice, header, menu, advert, side, form) if rng.random() < 0.4]
        after = [f() for f in (share, side, comments, form, advert, notice) if rng.random() < 0.35]
        rng.shuffle(before)
        rng.shuffle(after)
        middle = f"<!-- {word()} -->" + article()
        if rng.random() < 0.3:
            middle = f'<div class="{pick(["wrapper", "container", "page", "row"])}">{middle}{pick(["", side(), comments()])}</div>'
        alone = rng.random() < 0.1  # a page of nothing but its article
        body = middle if alone else "".join(before) + middle + "".join(after) + (footer() if rng.random() < 0.8 else "")
        layout = lambda: " ".join([pick(["single", "home", "layout", "theme-x"]), pick([
            "has-sidebar", "page-with-sidebar", "with-comments", "nav-open", "cookie-shown", "has-footer", "search-enabled",
            "ads-on", "header-fixed", "share-bar-left", "login-off", "no-related"])])
        if rng.random() < 0.04:
            body, bare = prose(1, 9), True
        else:
            bare = False
            if rng.random() < (0.6 if alone else 0.25):
                body = f'<div class="{layout()}">{body}</div>'
            if rng.random() < (0.4 if alone else 0.15):
                body = f'<form id="{pick(["aspnetForm", "form1", "pageForm"])}" action="/{word()}">{re.sub("<(/?)form", "<\\1div", body)}</form>'
        names = f' class="{layout()}"' if rng.random() < 0.3 else ""
        pages.append(f"<!DOCTYPE html><html><head><title>{phrase(2, 6)}</title><style>p{{margin:0}}</style></head>"
                     f'<body{names} data-gold="{int(bare)}">{body}</body></html>')
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages())


def extract(pages: DataFrame, model: Model | None = None, column: str = "text", html_col: str = "html") -> DataFrame:
    """``pages`` and a ``column`` with the main text of each page."""
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model())  # some hundred weights

    @F.pandas_udf("string")
    def run(html):
        import pandas as pd

        out = []
        for at in range(0, len(html), BATCH):
            out += ["\n".join(blocks) for blocks in sent.value.content(html.iloc[at:at + BATCH].tolist())]
        return pd.Series(out, dtype=object)

    return pages.withColumn(column, run(F.col(html_col).cast("string")))
