"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded down the tree.

Nodes are the block elements and controls (button, label), inline elements that stand in a
container or carry attribute tokens of something that is not text, and text that stands in the
body itself; other inline elements are part of their block. Every node gets features (tag,
attribute tokens of its own and its ancestors, depth, subtree density, siblings). Boosted trees give the odds that it belongs to the main
text. Decoding picks the best set of nodes in which a kept node's ancestors are all kept:
over the tree, a node is either dropped with all below it or kept with its children's best.

The trees are fitted on a bounded sample of the pages at hand: what stands in an article
or main element (outside navigation, asides and the like) is main text, the rest not. If
no page of the sample has such an element, all that is outside navigation and the like is.
Altered copies of the sample pages teach the model other page plans: renamed containers
and added menus, sidebars, notices, adverts, forms and comment sections.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 300
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3
SEED = 6

#: Fixed lists of HTML: elements without content, elements whose content is no text, inline elements, and which start tags end an open element.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template head title".split())
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var img wbr input".split())
#: In these, and in the body, an inline element is a node of its own; text of the body is one under this name.
CONTAINERS = set("div section article main nav aside header footer form fieldset dialog menu ul ol dl table tr".split())
BARE = "#text"
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table div section article main aside nav body".split())

TAG_GROUPS = [
    {"article", "main"},
    {"div", "section"},
    {"p"},
    {"h1"},
    {"h2", "h3", "h4", "h5", "h6", "hgroup"},
    {"ul", "ol", "dl", "menu"},
    {"li", "dt", "dd"},
    {"nav"},
    {"aside"},
    {"header"},
    {"footer", "address"},
    {"form", "fieldset", "legend", "dialog"},
    {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"},
    {"blockquote", "pre", "figure", "figcaption"},
    {"button", "label", "select", "option", "textarea", "output"},
    INLINE,
    {BARE},
]
ATTRIBUTE_GROUPS = [
    r"article|content|post|entry|story|main|body|text|prose",
    r"nav|menu|breadcrumb|toc|pagination|pager|tabs?",
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|dfp|teaser",
    r"sidebar|aside|related|widget|recommend\w*|rail|more",
    r"cookie\w*|consent|gdpr|notice|popup|modal|overlay|alert|newsletter|subscribe|paywall|toast",
    r"comments?|reply|replies|disqus|respond|discussion|reader",
    r"footer|copyright|legal|colophon|bottom",
    r"header|masthead|logo|brand|top|toolbar",
    r"share|sharing|social|follow|tags?|meta",
    r"form|search|login|signup|contact|hidden",
]
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<[!?][^>]*>", re.S)
#: Searched in the source itself: a lower-cased copy can be longer. ASCII, so that no other letter counts as an s.
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I | re.A) for t in RAW}
_BODY = re.compile(r"<body(?=[\s/>]|\Z)", re.I | re.A)
_ATTRIBUTES = re.compile(r"(?:class|id|role|aria-label|data-component|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_GROUPS = [re.compile(rf"(?:^|[^a-z])(?:{g})(?:$|[^a-z])") for g in ATTRIBUTE_GROUPS]
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


class Page:
    """The nodes of a page in order of their starts, and its text by pieces.

    tags, attributes, parents, inline: by node; pieces: (node, text, whether in a link); a piece
    belongs to the nearest node. Blocks and <br> part words.
    """

    __slots__ = ("tags", "attributes", "parents", "inline", "pieces")

    def __init__(self, source: str):
        self.tags, self.attributes, self.parents, self.inline = ["html"], [""], [-1], [False]
        self.pieces: list[tuple[int, str, bool]] = []
        open_, places, at = [("html", 0)], {}, 0  # places: by tag, where in open_ it stands
        links, add = places.setdefault("a", []), self.pieces.append
        n = len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            here = open_[-1][1]
            end = m.start() if m else n
            if end > at:
                said = entities.unescape(source[at:end])
                add((self._node(BARE, "", 0, True) if here == 0 and not said.isspace() else here, said, bool(links)))
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "br":
                    add((here, " ", False))
                if places.get(tag):
                    self._cut(open_, places, places[tag][-1])
                    if tag not in INLINE:
                        add((open_[-1][1], " ", False))
                continue
            if tag in RAW:
                if tag == "head":
                    stop = _ENDS[tag].search(source, at) or _BODY.search(source, at)
                    at = stop.start() if stop else at
                elif not m[0].endswith("/>"):
                    stop = _ENDS[tag].search(source, at)
                    # Without an end, scripts and styles go on to the end of the page, as in HTML; others hide nothing.
                    at = stop.end() if stop else n if tag in ("script", "style") else at
                continue
            if tag in VOID:
                if tag not in INLINE:
                    add((here, " ", False))
                continue
            if tag in ("html", "body"):
                continue
            if tag in ENDS_P:
                self._close(open_, places, {"p"})
            elif tag in SAME_ENDS:
                self._close(open_, places, SAME_ENDS[tag])
            elif tag == "a" and links:
                self._close(open_, places, {"a"})
            if tag in INLINE:
                if not m[0].endswith("/>"):
                    block = open_[-1][1]
                    apart = block == 0 or self.tags[block] in CONTAINERS or any(_flags(m[3])[1:])
                    places.setdefault(tag, []).append(len(open_))
                    open_.append((tag, self._node(tag, m[3], block, True) if apart else block))
                continue
            self._node(tag, m[3], open_[-1][1], False)
            add((len(self.tags) - 1, " ", False))
            if not m[0].endswith("/>"):
                places.setdefault(tag, []).append(len(open_))
                open_.append((tag, len(self.tags) - 1))

    def _node(self, tag: str, attributes: str, parent: int, inline: bool) -> int:
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.parents.append(parent)
        self.inline.append(inline)
        return len(self.tags) - 1

    @staticmethod
    def _cut(open_, places, depth: int) -> None:
        """Close the open elements from depth on; each is closed once, so a page takes linear time."""
        while len(open_) > depth:
            places[open_.pop()[0]].pop()

    @classmethod
    def _close(cls, open_, places, ends) -> None:
        """Close the innermost of ends, unless a scope is open inside it."""
        nearest = lambda tags: max((places[t][-1] for t in tags if places.get(t)), default=0)
        depth = nearest(ends)
        if depth > nearest(SCOPES):
            cls._cut(open_, places, depth)

    def text(self, kept) -> str:
        """The pieces of kept nodes: white space to one space, character references decoded. Of a dropped inline node nothing stays."""
        return " ".join("".join(t if kept[i] else "" if self.inline[i] else " " for i, t, _ in self.pieces).split())


_attribute_flags: dict[str, tuple] = {}


def _flags(attributes: str) -> tuple:
    if not attributes:
        return (0,) * len(_GROUPS)
    found = _attribute_flags.get(attributes)
    if found is None:
        words = " ".join(x.strip("\"'") for x in _ATTRIBUTES.findall(attributes)).lower()
        found = tuple(int(bool(g.search(words))) for g in _GROUPS)
        if _HIDDEN.search(attributes):
            found = (*found[:-1], 1)
        if len(_attribute_flags) > 50_000:
            _attribute_flags.clear()
        _attribute_flags[attributes] = found
    return found


_GROUP_OF = {t: i for i, g in enumerate(TAG_GROUPS) for t in g}
N_FEATURES = len(TAG_GROUPS) * 2 + len(_GROUPS) * 2 + 14


def page_features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(features, own text lengths) of the block elements of a page."""
    n = len(page.tags)
    own, link, marks = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, text, linked in page.pieces:
        k = len(text)
        if k > 1 or text != " ":
            own[i] += k
            marks[i] += text.count(".") + text.count(",")
            if linked:
                link[i] += k
    parents = page.parents
    sub, sub_link, sub_marks, nodes, children = own.copy(), link.copy(), marks.copy(), np.ones(n), np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        sub[p] += sub[i]
        sub_link[p] += sub_link[i]
        sub_marks[p] += sub_marks[i]
        nodes[p] += nodes[i]
        children[p] += 1
    depth, place, before = np.zeros(n), np.zeros(n), np.zeros(n)
    seen, last, same = [0] * n, [-1] * n, np.zeros(n)
    previous, following = np.zeros(n), np.zeros(n)
    g, a = len(TAG_GROUPS), len(_GROUPS)
    x = np.zeros((n, N_FEATURES))
    passed = 0.0
    for i in range(n):
        group = _GROUP_OF.get(page.tags[i])
        if group is not None:
            x[i, group] = 1
        own_flags = _flags(page.attributes[i])
        x[i, 2 * g : 2 * g + a] = own_flags
        before[i] = passed
        passed += own[i]
        p = parents[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            x[i, g : 2 * g] = np.maximum(x[p, g : 2 * g], x[p, :g])
            x[i, 2 * g + a : 2 * g + 2 * a] = np.maximum(x[p, 2 * g + a : 2 * g + 2 * a], x[p, 2 * g : 2 * g + a])
            place[i] = seen[p]
            seen[p] += 1
            if (b := last[p]) >= 0:
                previous[i], following[b] = sub[b], sub[i]
                same[i] = page.tags[b] == page.tags[i]
            last[p] = i
    total = max(1.0, own.sum())
    shares = [np.log1p(own), np.log1p(sub), sub / total, sub_link / np.maximum(sub, 1), sub / nodes, sub_marks / np.maximum(sub, 1), depth, children, place, np.log1p(previous), np.log1p(following), before / total, same, np.log1p(nodes)]
    x[:, 2 * g + 2 * a :] = np.stack(shares, axis=1)
    return x, own


class Boosted:
    """Gradient-boosted trees for log-odds: arrays of split feature, threshold and leaf value, a full tree of DEPTH levels each."""

    def __init__(self, base: float = 0.0):
        self.base, self.trees = base, []

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = TREES) -> Boosted:
        if not len(x):
            return self
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        p = float(np.clip((y * w).sum() / w.sum(), 1e-3, 1 - 1e-3))
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = (y - p) * w, np.maximum(p * (1 - p), 1e-6) * w
            node = np.zeros(len(y), np.int64)
            feature, cut = np.full(2**DEPTH - 1, -1), np.full(2**DEPTH - 1, np.inf)
            for level in range(DEPTH):
                first, count = 2**level - 1, 2**level
                local = node - first
                best = np.zeros(count)
                gains_at = [(-1, np.inf, 0)] * count
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    k = len(e) + 1
                    at = local * k + binned[:, f]
                    sg = np.bincount(at, grad, count * k).reshape(count, k).cumsum(axis=1)
                    sh = np.bincount(at, hess, count * k).reshape(count, k).cumsum(axis=1)
                    tg, th = sg[:, -1:], sh[:, -1:]
                    gain = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                    gain[(sh < 1) | (th - sh < 1)] = 0
                    pick = gain[:, :-1].argmax(axis=1)
                    value = gain[np.arange(count), pick]
                    for c in np.flatnonzero(value > best + 1e-9):
                        best[c] = value[c]
                        gains_at[c] = (f, e[pick[c]], pick[c])
                right = np.zeros(len(y), np.int64)
                for c, (f, edge, b) in enumerate(gains_at):
                    feature[first + c], cut[first + c] = f, edge
                    if f >= 0:
                        here = local == c
                        right[here] = binned[here, f] > b
                node = 2 * node + 1 + right
            leaf = node - (2**DEPTH - 1)
            value = RATE * np.bincount(leaf, grad, 2**DEPTH) / (np.bincount(leaf, hess, 2**DEPTH) + 1)
            self.trees.append((np.maximum(feature, 0), cut, value))
            score += value[leaf]
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of x."""
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            score += value[node - (2**DEPTH - 1)]
        return score


def decode(odds: np.ndarray, own: np.ndarray, parents: list[int]) -> np.ndarray:
    """Kept elements: of all sets closed under ancestors, the one with the largest sum of odds weighted by text.

    Elements without text of their own weigh little; the root, which has no text of its own, is always kept.
    """
    n = len(parents)
    value = odds * (0.05 + np.sqrt(own))
    for i in range(n - 1, 0, -1):
        if value[i] > 0:
            value[parents[i]] += value[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[parents[i]] and value[i] > 0
    return kept


_BOILERPLATE_TAGS = {"nav", "aside", "footer", "header", "form", "fieldset", "dialog", "menu", "button", "label", "select", "textarea"}


def page_labels(page: Page, anywhere: bool = False) -> np.ndarray | None:
    """1 for elements of the main text and what holds them; None if the page has no article or main element.

    anywhere: as if the page were one article.
    """
    n = len(page.tags)
    state = np.full(n, int(anywhere))  # 1: in the article, -1: boilerplate
    for i in range(1, n):
        up = state[page.parents[i]]
        flags = _flags(page.attributes[i])
        if up == -1 or page.tags[i] in _BOILERPLATE_TAGS or any(flags[1:]):
            state[i] = -1
        elif up == 1 or page.tags[i] in ("article", "main") or "data-main" in page.attributes[i]:
            state[i] = 1
    if not (state == 1).any() and not anywhere:
        return None
    label = (state == 1).astype(float)
    for i in range(n - 1, 0, -1):
        if label[i]:
            label[page.parents[i]] = 1
    return label


def altered(source: str, rng: random.Random) -> str:
    """A copy of a page with another plan: renamed containers and blocks of other kinds around and in the article."""
    words = re.findall(r"[^\W\d_]{2,}", re.sub(r"<[^>]*>", " ", source))[:400] or ["text"]

    def say(low, high):
        out = rng.choices(words, k=rng.randint(low, high))
        return " ".join(out).capitalize() + "."

    def items(n):
        return "".join(f'<li><a href="/{i}">{say(1, 3)[:-1]}</a></li>' for i in range(n))

    kinds = [
        lambda: f'<aside class="sidebar"><h3>{say(1, 3)}</h3><ul>{items(rng.randint(3, 8))}</ul><p>{say(5, 20)}</p></aside>',
        lambda: f'<div class="{rng.choice(["sidebar", "widget", "related-posts", "right-rail"])}"><h4>{say(1, 3)}</h4><p>{say(5, 40)}</p></div>',
        lambda: f'<div class="{rng.choice(["cookie-notice", "consent-banner", "newsletter", "alert", "popup"])}"><p>{say(8, 40)}</p><button>OK</button></div>',
        lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "sponsored", "promo"])}">{say(3, 25)}</div>',
        lambda: f'<form action="/s" class="search"><label>{say(1, 3)}</label><input name="q"><button>{say(1, 2)}</button></form>',
        lambda: f"<form>{say(3, 12)}<p>{say(3, 12)}</p></form>",
        lambda: f'<section class="{rng.choice(["comments", "comment-list", "responses reader-comments"])}"><h2>{say(1, 2)}</h2>' + "".join(f'<div class="comment"><p>{say(5, 60)}</p></div>' for _ in range(rng.randint(1, 4))) + "</section>",
        lambda: f'<div id="comments">' + "".join(f"<p>{say(10, 50)}</p>" for _ in range(rng.randint(1, 4))) + "</div>",
        lambda: f"<header><p>{say(2, 10)}</p></header>",
        lambda: f'<div class="share">{say(1, 5)}</div>',
        lambda: f'<ul class="menu">{items(rng.randint(3, 9))}</ul>',
        lambda: f'<div class="footer"><p>{say(4, 20)}</p></div>',
        lambda: f'<span class="{rng.choice(["cookie-notice", "alert", "promo", "share", "ad"])}">{say(2, 15)}</span>',
        lambda: f"<button>{say(1, 4)}</button>",
        lambda: f'<a class="{rng.choice(["share", "follow", "more", "login"])}" href="/x">{say(1, 4)}</a>',
    ]
    around = [lambda: say(1, 12), lambda: f"<span>{say(1, 8)}</span>", lambda: "".join(f'<a href="/{i}">{say(1, 3)[:-1]}</a> ' for i in range(rng.randint(1, 6))), lambda: f"<b>{say(1, 5)}</b> {say(1, 9)}"]
    inside = [lambda: say(5, 40), lambda: f"<b>{say(1, 5)}</b> {say(5, 30)}", lambda: f'{say(3, 20)} <a href="/{rng.random()}">{say(1, 4)[:-1]}</a> {say(3, 20)}', lambda: f"<span>{say(5, 30)}</span>", lambda: f"<em>{say(2, 9)}</em>"]
    out = source
    spots = [("<article", False), ("</article>", True), ("</article>", False), ("<footer", False)]
    for spot, after in spots:
        for _ in range(rng.randint(0, 2)):
            i = out.find(spot)
            if i >= 0:
                i += len(spot) if after else 0
                out = out[:i] + rng.choice(kinds)() + out[i:]
    controls = [lambda: f"<button>{say(1, 4)}</button>", lambda: f'<span class="{rng.choice(["share", "ad", "promo", "newsletter"])}">{say(1, 6)}</span>', lambda: f'<a class="{rng.choice(["share", "follow", "reply"])}" href="/y">{say(1, 3)}</a>']
    if rng.random() < 0.5:  # in the text's paragraphs
        out = re.sub(r"</p>", lambda m: rng.choice(controls)() + "</p>" if rng.random() < 0.2 else m[0], out)
    for spot, what in (("<body>", around), ("</body>", around), ("<article>", inside), ("</article>", inside)):
        if rng.random() < 0.4:
            i = out.find(spot)
            if i >= 0:
                i += len(spot) if spot in ("<body>", "<article>") else 0
                out = out[:i] + rng.choice(what)() + out[i:]
    plan = rng.random()
    if plan < 0.35:
        name = rng.choice(['div class="content"', 'div id="main-text"', 'div class="post"', "div", 'section class="story"', "main"])
        out = out.replace("<article>", f"<{name} data-main>", 1).replace("</article>", f"</{name.split()[0]}>", 1)
    if rng.random() < 0.5:
        out = re.sub(r"(</p>)", lambda m: m[1] if rng.random() < 0.9 else f"</p><h2>{say(1, 5)}</h2><blockquote>{say(5, 20)}</blockquote><ul><li>{say(3, 12)}</li><li>{say(3, 12)}</li></ul>", out)
    return out


def train(pages: DataFrame, *, sample_pages: int = SAMPLE_PAGES, seed: int = SEED) -> Boosted:
    """Fit on the pages of least page_id hash, sample_pages at most, each as it is and altered twice."""
    place = F.xxhash64("page_id")
    chosen = pages.where(F.col("html").isNotNull()).select("page_id").distinct().orderBy(place, "page_id").limit(sample_pages)

    def examples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page_id, place, source in zip(frame["page_id"], frame["place"], frame["html"], strict=True):
                rng = random.Random(f"{seed} {page_id}")
                for k, text in enumerate((source, altered(source, rng), altered(source, rng))):
                    page = Page(text)
                    label = page_labels(page)
                    x, own = page_features(page)
                    y = page_labels(page, anywhere=True) if label is None else label
                    out.append((place, k, label is not None, x[1:].tobytes(), y[1:].tobytes(), own[1:].tobytes()))
            yield pd.DataFrame(out, columns=["place", "k", "marked", "x", "y", "own"])

    rows = pages.join(F.broadcast(chosen), "page_id").where(F.col("html").isNotNull()).select("page_id", place.alias("place"), "html")
    rows = rows.mapInPandas(examples, "place long, k int, marked boolean, x binary, y binary, own binary").toPandas().sort_values(["place", "k", "x"])
    rows = rows[rows["marked"]] if rows["marked"].any() else rows
    if not len(rows):
        return Boosted()
    x, y, own = (np.frombuffer(b"".join(rows[c]), dtype=np.float64) for c in ("x", "y", "own"))
    return Boosted().fit(x.reshape(-1, N_FEATURES), y, 0.5 + np.sqrt(np.minimum(own, 400)) / 20)


def extract(source: str | None, model: Boosted) -> str:
    """The main text of one page; null and empty pages give the empty text."""
    return extract_all([source], model)[0]


def extract_all(sources, model: Boosted) -> list[str]:
    pages = [Page(s or "") for s in sources]
    made = [page_features(p) for p in pages]
    if not made:
        return []
    odds = model.odds(np.vstack([x for x, _ in made]))
    out, at = [], 0
    for page, (x, own) in zip(pages, made, strict=True):
        out.append(page.text(decode(odds[at : at + len(x)], own, page.parents)))
        at += len(x)
    return out


def extract_text(pages: DataFrame, model: Boosted) -> DataFrame:
    """page_id, url and text of every row; rows of repeated ids each have their own."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def extracted(sources: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(sources), 500):
            out += extract_all(sources.iloc[i : i + 500], held.value)
        return pd.Series(out, dtype=object)

    return pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
