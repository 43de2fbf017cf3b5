"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded hierarchically.

A page is parsed into its block elements; inline elements only add to the statistics of
the block they are in. Each node gets features of its subtree (text, link and sentence
density), its tag and attribute tokens and those of its ancestors, its depth, its place
on the page and its siblings. Boosted trees, trained in numpy, give the log-odds that a
node is article text. Decoding then chooses, for every node from the leaves up, between
keeping its subtree whole, dropping it whole and leaving the choice to its children at a
price; a kept node has no dropped descendant and the other way round, except below a
node that was split.

The trees learn from at most ``TRAIN_PAGES`` pages (smallest hash of the html): texts in
and outside their article or main element are laid out anew in many ways, with and
without telling names, so that the model does not depend on this corpus' own markup.
Words that stand for each kind of container are fixed values below.

Null and empty html and pages without text give the empty text. Repeated rows get equal
rows. Nothing is shuffled; a page is held whole by one worker.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import bounded_sample, replace_columns, table

TRAIN_PAGES = 300
LAYOUTS = 3  # made of each training page
TREES, DEPTH, BINS, SHRINK, L2 = 60, 4, 32, 0.2, 1.0
SPLIT_PRICE = 1.0
PAGES_AT_ONCE = 256

# HTML element names by their role.
RAW = set("script style textarea title".split())  # nothing but their end tag, or the end of the page, ends them
#: Left out with what they hold, if they are closed; without end tag, options and buttons reach to the next tag of a block and the others hold nothing.
DROPPED = set("noscript template iframe svg select option button object canvas annotation annotation-xml".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
INLINE |= set("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
#: An opening tag of the value closes an open element of the key.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
# Words in class, id and role that tell what a container is for.
NAMES: dict[str, list[str]] = {
    "content": "article content main post entry story body text page".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc links tabs".split(),
    "ad": "ad ads advert advertisement adsense banner promo promotion sponsor sponsored".split(),
    "frame": "header footer masthead top bottom copyright legal foot head".split(),
    "side": "sidebar aside side widget related recommended share social tags rail".split(),
    "notice": "cookie cookies notice consent popup modal alert newsletter subscribe signup gdpr disclaimer".split(),
    "comment": "comment comments reply replies respond disqus reader readers discussion feedback".split(),
    "form": "form search login register contact".split(),
}
KINDS = list(NAMES)
_KIND = {w: i for i, k in enumerate(KINDS) for w in NAMES[k]}
TAG_KIND = {"article": "content", "main": "content", "nav": "menu", "menu": "menu", "header": "frame", "footer": "frame", "aside": "side", "form": "form", "dialog": "notice", "fieldset": "form"}
TAGS = {t: i + 1 for i, t in enumerate("p h1 h2 h3 h4 h5 h6 div section article main ul ol li table tr td th blockquote pre dl dd dt figure figcaption header footer nav aside form body address".split())}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*+>|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+))*+)(?:>|\Z)", re.S | re.I)
_RAW_END = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in RAW}
_RAW_END_IN_SVG = {t: re.compile(rf"</{t}\s*>|(?=</svg\s*>)|\Z", re.I) for t in RAW}
_ATTR = re.compile(r"""([^\s/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|(\S*)))?""")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACES = re.compile(r"\s+")


class Token(NamedTuple):
    """A comment or declaration (no name), a raw element as a whole or a tag."""

    start: int
    stop: int
    name: str
    end: bool
    attrs: str
    gap: bool  # it parts the words beside it

    @property
    def empty(self) -> bool:
        return self.attrs.rstrip().endswith("/")


def tokens(source: str) -> list[Token]:
    """Tokens in page order. In svg a raw element may be self-closed, and does not reach beyond it."""
    out, at, svg = [], 0, 0
    while m := _TOKEN.search(source, at):
        at, name, attrs = m.end(), (m["tag"] or "").lower(), m["attrs"] or ""
        if name in RAW and not m["end"]:
            if not (svg and attrs.rstrip().endswith("/")):
                at = (_RAW_END_IN_SVG if svg else _RAW_END)[name].search(source, at).end()
            out.append(Token(m.start(), at, "", False, "", True))
            continue
        t = Token(m.start(), at, name, bool(m["end"]), attrs, m[0].startswith("<![CDATA["))
        if name == "svg" and (t.end or not t.empty):
            svg = max(0, svg - 1) if t.end else svg + 1
        out.append(t)
    return out


def dropped(found: list[Token], size: int) -> dict[int, tuple[int, int]]:
    """By the place of a DROPPED element's tag: the place of the first token after the element, and the character there."""
    out, opened = {}, {}
    for i, t in enumerate(found):
        if t.name not in DROPPED:
            continue
        if not t.end:
            out[i] = i + 1, t.stop
            if t.name != "svg" or not t.empty:
                opened.setdefault(t.name, []).append(i)
        elif opened.get(t.name):
            out[opened[t.name].pop()] = i + 1, t.stop
    for i in [*opened.get("button", []), *(i for i in out if found[i].name == "option")]:
        k = next((k for k in range(i + 1, len(found)) if found[k].name and found[k].name not in INLINE), None)
        if k is None:
            out[i] = len(found), size
        elif found[k].end and found[k].name == found[i].name:
            out[i] = k + 1, found[k].stop
        else:
            out[i] = k, found[k].start
    return out


class Page:
    """Block elements in page order, and the text blocks with the element each belongs to.

    A quote opens a value right behind its ``=`` alone, and reaches to the next one like it; without one, and
    anywhere else, it is a character. A tag that is open at the end of the page has no text.
    ``labelled`` reads the labels that ``layout`` writes; other pages may hold any attributes.
    """

    def __init__(self, source: str, labelled: bool = False):
        self.tag, self.parent, self.kinds, self.label = ["body"], [-1], [0], [None]
        self.blocks: list[tuple[int, str]] = []
        self.links: list[int] = [0]  # characters of link text, own
        stack, inline, pieces, at = [(0, "body")], [], [], 0

        def flush():
            text = _SPACES.sub(" ", "".join(pieces)).strip()
            pieces.clear()
            if text:
                self.blocks.append((stack[-1][0], text))

        def add(text: str):
            if text:
                text = entities.unescape(text) if "&" in text else text
                pieces.append(text)
                if "a" in inline:
                    self.links[stack[-1][0]] += len(text.strip())

        found = tokens(source)
        beyond, k = dropped(found, len(source)), 0
        while k < len(found):
            m = found[k]
            add(source[at : m.start])
            at, tag = m.stop, m.name
            k += 1
            if not tag:
                if m.gap:
                    pieces.append(" ")
                continue
            if tag in DROPPED:
                if not m.end:
                    pieces.append(" ")
                    k, at = beyond[k - 1]
                continue
            if tag in INLINE:
                if tag in ("br", "img", "wbr"):
                    pieces.append(" " if tag != "wbr" else "")
                elif tag == "a":
                    inline.append("a") if not m.end else inline.clear()
                continue
            if tag in ("html", "body", "head"):
                continue
            flush()
            inline.clear()
            if m.end:
                if any(t == tag for _, t in stack[1:]):
                    while stack[-1][1] != tag:
                        stack.pop()
                    stack.pop()
                continue
            if tag in VOID:
                continue
            while len(stack) > 1 and (stack[-1][1] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or tag in CLOSED_BY.get(stack[-1][1], ())):
                stack.pop()
            kinds = 1 << KINDS.index(TAG_KIND[tag]) if tag in TAG_KIND else 0
            label = None
            for a in _ATTR.finditer(m.attrs):
                value, name = a[2] or a[3] or a[4] or "", a[1].lower()
                if labelled and name == "data-y":
                    label = int(value)
                if name not in ("class", "id", "role"):
                    continue
                for word in _NAME.findall(_CAMEL.sub(" ", value).lower()):
                    if word in _KIND:
                        kinds |= 1 << _KIND[word]
            self.tag.append(tag)
            self.parent.append(stack[-1][0])
            self.kinds.append(kinds)
            self.label.append(label if label is not None else self.label[stack[-1][0]])
            self.links.append(0)
            if not m.empty:
                stack.append((len(self.tag) - 1, tag))
        add(source[at:])
        flush()

    def features(self) -> np.ndarray:
        n = len(self.tag)
        parent = np.array(self.parent)
        own, blocks, stops, words, order = (np.zeros(n) for _ in range(5))
        total = max(1, sum(len(t) for _, t in self.blocks))
        seen = 0
        for k, t in self.blocks:
            own[k] += len(t)
            blocks[k] += 1
            words[k] += t.count(" ") + 1
            stops[k] += sum(map(t.count, ".,;!?"))
            order[k] = seen / total
            seen += len(t)
        sub = np.stack([own, blocks, stops, words, np.array(self.links, float), np.ones(n), [t == "li" for t in self.tag], [t == "p" for t in self.tag]], 1).astype(float)
        depth, above = [0] * n, [0] * n
        for k in range(1, n):  # children come after their parents
            depth[k] = depth[self.parent[k]] + 1
            above[k] = above[self.parent[k]] | self.kinds[self.parent[k]]
        depth, above = np.array(depth), np.array(above)
        for d in range(int(depth.max()), 0, -1):
            at = np.flatnonzero(depth == d)
            np.add.at(sub, parent[at], sub[at])
            later = at[::-1]
            order[parent[later]] = np.where(order[parent[later]] == 0, order[later], order[parent[later]])
        siblings = np.bincount(parent[1:], minlength=n)
        text_of_siblings = np.bincount(parent[1:], sub[1:, 0], minlength=n)
        place, count = [0] * n, [0] * n
        for k in range(1, n):
            place[k] = count[self.parent[k]]
            count[self.parent[k]] += 1
        place = np.array(place)
        p = np.maximum(parent, 0)
        length = np.maximum(sub[:, 0], 1)
        kinds = np.array(self.kinds)
        bits = lambda v: [(v >> i & 1).astype(float) for i in range(len(KINDS))]
        return np.stack([
            np.array([TAGS.get(t, 0) for t in self.tag]), np.array([TAGS.get(self.tag[k], 0) for k in p]), depth, np.log1p(own), np.log1p(sub[:, 0]), sub[:, 0] / total,
            sub[:, 4] / length, sub[:, 2] / length, sub[:, 3] / np.maximum(sub[:, 1], 1), sub[:, 0] / sub[:, 5], sub[:, 6] / sub[:, 5], sub[:, 7] / sub[:, 5], np.log(sub[:, 5]),
            order, order + sub[:, 0] / total, siblings[p], place / np.maximum(siblings[p], 1), sub[:, 0] / np.maximum(text_of_siblings[p], 1), sub[p, 4] / np.maximum(sub[p, 0], 1),
            sub[p, 2] / np.maximum(sub[p, 0], 1), *bits(kinds), *bits(above)], 1).astype(np.float32)


class Boosted:
    """Regression trees on binned features, fitted to the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self.binned(x)
        self.base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        f, self.trees = np.full(len(y), self.base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree = self.grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            f += self.leaf(tree, binned)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], 1).astype(np.int16)

    def grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        """Arrays of a complete tree: feature, bin and value per node; feature -1 is a leaf."""
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        node = np.zeros(len(g), int)
        for level in range(DEPTH + 1):
            first, width = 2**level - 1, 2**level
            at = node - first
            live = (at >= 0) & (at < width)
            sg, sh = (np.bincount(at[live], v[live], minlength=width) for v in (g, h))
            value[first : first + width] = -SHRINK * sg / (sh + L2)
            if level == DEPTH:
                break
            best = np.full(width, 1e-3)
            for j in range(b.shape[1]):
                key = at[live] * BINS + b[live, j]
                cg, ch = (np.bincount(key, v[live], minlength=width * BINS).reshape(width, BINS).cumsum(1) for v in (g, h))
                gain = cg**2 / (ch + L2) + (sg[:, None] - cg) ** 2 / (sh[:, None] - ch + L2) - (sg**2 / (sh + L2))[:, None]
                k = gain[:, :-1].argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better], cut[first : first + width][better] = j, k[better]
            split = live & (feature[np.minimum(node, size - 1)] >= 0)
            n = node[split]
            node[split] = 2 * n + 1 + (b[split, feature[n]] > cut[n])
        return feature, cut, value

    def leaf(self, tree, b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(b), int)
        for _ in range(DEPTH):
            f = feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (b[np.arange(len(b)), np.maximum(f, 0)] > cut[node]), node)
        return value[node]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.base + sum(self.leaf(t, b) for t in self.trees)


def decode(parent: list[int], odds: np.ndarray, has_text: np.ndarray) -> np.ndarray:
    """Which nodes' own text is kept. A split costs SPLIT_PRICE against keeping or dropping a subtree whole."""
    n = len(parent)
    own = np.clip(odds, -6, 6) * has_text
    own = own.tolist()
    keep, mixed, best = list(own), [max(x, 0.0) for x in own], [0.0] * n
    for k in range(n - 1, -1, -1):  # children come after their parents
        best[k] = max(keep[k], 0.0, mixed[k] - SPLIT_PRICE)
        if k:
            keep[parent[k]] += keep[k]
            mixed[parent[k]] += best[k]
    kept, forced = np.zeros(n, bool), [None] * n
    for k in range(n):
        f = forced[parent[k]] if k else None
        if f is None and best[k] == keep[k] and keep[k] > 0:
            f = True
        elif f is None and best[k] == 0.0:
            f = False
        forced[k] = f
        kept[k] = f if f is not None else own[k] > 0
    return kept


def extract(sources: list[str | None], model: Boosted) -> list[str]:
    """The main text of each page; the trees run over the nodes of ``PAGES_AT_ONCE`` pages together."""
    out = []
    for i in range(0, len(sources), PAGES_AT_ONCE):
        pages = [Page(s if isinstance(s, str) else "") for s in sources[i : i + PAGES_AT_ONCE]]
        odds = model.log_odds(np.concatenate([p.features() for p in pages]))
        first = 0
        for page in pages:
            n = len(page.tag)
            has_text = np.zeros(n)
            has_text[[k for k, _ in page.blocks]] = 1
            kept = decode(page.parent, odds[first : first + n], has_text)
            first += n
            out.append("\n".join(t for k, t in page.blocks if kept[k]))
    return out


def taught(source: str) -> tuple[list[str], list[str]]:
    """Texts inside and outside of a page's article or main element; none inside if it has neither."""
    page = Page(source)
    content, other = 1 << KINDS.index("content"), ~(1 << KINDS.index("content"))
    good, bad = [], []
    for k, t in page.blocks:
        inside, marked, at = False, False, k
        while at >= 0:
            inside |= page.tag[at] in ("article", "main")
            marked |= bool(page.kinds[at] & other) and not (page.kinds[at] & content)
            at = page.parent[at]
        (good if inside and not marked else bad).append(t)
    return (good, bad) if good else ([], [])


def layout(r: np.random.Generator, good: list[str], bad: list[str]) -> str:
    """A page with ``good`` as its article and boilerplate made of ``bad``; data-y holds the label of each part."""
    esc = entities.escape
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    chance = lambda p: r.random() < p
    words = (" ".join(bad) or "Home About Contact").split()
    short = lambda: " ".join(pick(words) for _ in range(int(r.integers(1, 4))))
    sentence = lambda: pick(good)[: int(r.integers(40, 300))] if chance(0.5) else " ".join(pick(words) for _ in range(int(r.integers(5, 25)))) + "."
    links = lambda n: "<ul>" + "".join(f'<li><a href="/x">{esc(short())}</a></li>' for _ in range(n)) + "</ul>"

    def named(tag: str, kind: str, inner: str, telling: float = 0.8) -> str:
        name = pick(NAMES[kind]) if chance(telling) else pick(["box", "block", "c1", "row", "wrap"])
        name = name + pick(["", "-box", "_area", "-1", "Wrap"])
        return f'<{tag} {pick(["class", "id"])}="{name}" data-y="0">{inner}</{tag}>'

    def boiler() -> str:
        return pick([
            lambda: named("div", "ad", pick([esc(sentence()), f"<p>{esc(sentence())}</p>", f'<a href="#">{esc(short())}</a>'])),
            lambda: f'<aside data-y="0"><h3>{esc(short())}</h3>{pick([links(5), "<p>" + esc(sentence()) + "</p>"])}</aside>',
            lambda: named("div", "side", f"<h3>{esc(short())}</h3>" + links(int(r.integers(3, 9)))),
            lambda: named("div", "notice", f"<p>{esc(sentence())} <a href='#'>{esc(short())}</a></p>"),
            lambda: f'<form data-y="0"><label>{esc(short())}</label><input><p>{esc(sentence())}</p></form>',
            lambda: named("div", "menu", links(int(r.integers(3, 9)))),
            lambda: named("div", "form", f"<label>{esc(short())}</label><input>{esc(short())}"),
        ])()

    def comments() -> str:
        one = lambda: f"<div class='{pick(['comment', 'reply', 'comment-item'])}'><b>{esc(short())}</b><p>{esc(sentence())}</p></div>"
        return named(pick(["section", "div", "ol"]), "comment", f"<h3>{esc(short())}</h3>" + "".join(one() for _ in range(int(r.integers(1, 6)))), 0.95)

    body = []
    for i, t in enumerate(good):
        if i == 0 and chance(0.6):
            body.append(pick(["<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>"]).format(esc(t[:60])))
        body.append(pick(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}</b></p>", "<ul><li>{}</li></ul>", "<blockquote><p>{}</p></blockquote>", "<h3>{}</h3>", "<pre>{}</pre>"]).format(esc(t)))
        if chance(0.05):
            body.append(boiler())
    main = "\n".join(body)
    tag, attr = pick([("article", ""), ("main", ""), ("div", f' class="{pick(NAMES["content"])}"'), ("div", f' id="{pick(NAMES["content"])}"'), ("section", ""), ("div", ""), ("div", ' class="c2"')])
    main = f'<{tag}{attr} data-y="1">{main}{comments() if chance(0.1) else ""}</{tag}>'
    if chance(0.4):
        main = f'<{pick(["main", "div", "section"])} data-y="0">{boiler() if chance(0.4) else ""}{main}{boiler() if chance(0.4) else ""}</div>'
    before = [pick([f'<nav data-y="0">{links(int(r.integers(3, 10)))}</nav>', named("div", "menu", links(6)), f'<header data-y="0"><h1>{esc(short())}</h1><p>{esc(sentence())}</p></header>', named("div", "frame", f"<h2>{esc(short())}</h2>")])]
    after = [pick([f'<footer data-y="0">&copy; {esc(sentence())}</footer>', named("div", "frame", f"<p>&copy; {esc(sentence())}</p>"), f'<footer data-y="0"><p>{esc(sentence())}</p>{links(3)}</footer>'])]
    before += [boiler() for _ in range(int(r.integers(0, 3)))]
    after = [*([comments()] if chance(0.4) else []), *[boiler() for _ in range(int(r.integers(0, 3)))], *after]
    return "<html><body data-y='0'>" + "".join(before) + main + "".join(after) + "</body></html>"


def fit(sources: list[str], seed: int = 11) -> Boosted:
    """Trees for the given pages. Without a page that marks its article, a plain sentence stands for one."""
    r = np.random.default_rng(seed)
    lessons = [x for x in map(taught, sources) if x[0]] or [(["This is the first sentence of an article, and it goes on for a while."] * 3, ["Home", "About us", "Contact"])]
    xs, ys = [], []
    pages = [layout(r, *x) for x in lessons for _ in range(LAYOUTS * max(1, 30 // len(lessons)))]
    for source in pages:
        page = Page(source, labelled=True)
        x = page.features()
        at = sorted({k for k, _ in page.blocks})
        xs.append(x[at])
        ys.extend(page.label[k] or 0 for k in at)
    for source in sources:  # the pages themselves, as they are marked
        good, _ = taught(source)
        if good:
            page, inside = Page(source), set(good)
            at = {k: t in inside for k, t in page.blocks}
            xs.append(page.features()[list(at)])
            ys.extend(at.values())
    return Boosted(np.concatenate(xs), np.array(ys, float))


def main_text(pages: DataFrame, source: str = "html", max_pages: int = TRAIN_PAGES) -> DataFrame:
    """``pages`` with the column text: the article's blocks, one to a line."""
    body = F.col(f"`{source}`")
    sample = bounded_sample(pages.where(body.isNotNull()).select(body.alias("s")), F.col("s"), max_pages)
    held = pages.sparkSession.sparkContext.broadcast(vars(fit([row["s"] for row in sample.collect()])))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Boosted.__new__(Boosted)
        model.__dict__.update(held.value)
        for b in batches:
            yield pd.Series(extract(list(b), model), dtype=object)

    return replace_columns(pages, {"text": run(body)})


def op6_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
