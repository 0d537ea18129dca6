"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is read into its block elements. Every element gets features of its tag,
of the words in its class, id and role, of its ancestors, of the text below it
(amount, density, share in links, sentence marks) and of its place among its
siblings. Boosted trees, trained here in numpy, give the probability that the
text below it is the article's. Decoding chooses for the whole tree at once:
an element is kept whole, dropped whole, or mixed, and only below a mixed one
may the choices differ, so no choice contradicts one above or below it.

The trees are fitted on a bounded sample of ``PAGES`` pages of at most
``LONGEST`` bytes. Labels follow from the pages' own semantic elements (article
or main, less navigation, footers, asides, forms, adverts and comments inside).
As these would teach tag names only, each sampled article is also dressed in
``LAYOUTS`` layouts of other elements and names with its blocks known.

Text: a block is the text between two block boundaries, with references decoded
and white space turned into single spaces; kept blocks follow in page order, one
a line. Scripts, styles, forms' controls and comments are never text. Null or
empty pages, and pages without an article, give an empty text. Unclosed and
stray tags are read the way browsers do for paragraphs, list items and cells.
"""

from __future__ import annotations

import random
import re
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, with_values

PAGES = 300
LAYOUTS = 3
LONGEST = 1 << 16
ROUNDS, DEPTH, RATE, BINS = 40, 4, 0.3, 32

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Kinds of HTML elements.
BLOCK = set("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th nav header footer aside form blockquote pre figure figcaption fieldset address details summary hr center menu hgroup search dialog".split())
SILENT = set("script style noscript template svg iframe object textarea select button title head math canvas audio video xmp noembed noframes".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = BLOCK - {"html", "body"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "thead", "tbody", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
# Names that pages give to their parts.
GOOD = set("article content main post entry story text body page prose".split())
BAD = set("nav navigation menu ad ads adv advert advertisement sponsor sponsored promo promotion footer foot header masthead sidebar side aside widget cookie cookies consent gdpr notice banner alert newsletter subscribe signup form search login comment comments reply replies respond disqus discussion share social related recommended more breadcrumb breadcrumbs copyright legal popup modal overlay toolbar pager pagination tags contentinfo complementary teaser".split())
NO_TAGS = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "search"}
YES_TAGS = {"article", "main"}
TAGS = ["article", "main", "section", "div", "p", "heading", "list", "li", "table", "cell", "nav", "header", "footer", "aside", "form", "blockquote", "body", "other"]
_KIND = {**{f"h{i}": "heading" for i in range(1, 7)}, "ul": "list", "ol": "list", "dl": "list", "td": "cell", "th": "cell", "dd": "li", "dt": "li", "menu": "nav", "search": "form", "dialog": "aside", "pre": "p", "address": "footer"}
_PLACE = {tag: i for i, tag in enumerate(TAGS)}

_names: dict[str, tuple[str, ...]] = {}


def names(attributes: str) -> tuple[str, ...]:
    """The words in an element's class, id and role."""
    found = _names.get(attributes)
    if found is None:
        if len(_names) > 50_000:
            _names.clear()
        found = tuple(w.lower() for m in _ATTRIBUTE.finditer(attributes) for w in _NAME.findall(m[2] or m[3] or m[4] or ""))
        _names[attributes] = found
    return found


class Page:
    """A page's block elements, parents first, and its blocks of text."""

    def __init__(self, html: str | None):
        self.tag, self.parent, self.names = ["html"], [-1], [()]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._read(html or "")

    def _read(self, html: str) -> None:
        stack, text = [0], []
        linked, links, silent = 0, 0, 0
        place, lower = 0, None

        def flush() -> None:
            nonlocal linked
            if text:
                line = " ".join("".join(text).split())
                if line:
                    self.blocks.append((stack[-1], line, min(linked, len(line))))
                text.clear()
            linked = 0

        def said(part: str) -> None:
            nonlocal linked
            if part and not silent:
                part = unescape(part) if "&" in part else part
                text.append(part)
                if links:
                    linked += len(part.strip())

        match = _TOKEN.search(html)
        while match:
            said(html[place : match.start()])
            place = match.end()
            tag = (match[2] or match[5] or "").lower()
            if not tag:
                pass
            elif match[1] or match[4]:
                if tag in SILENT:
                    silent = max(0, silent - 1)
                elif tag == "a":
                    links = max(0, links - 1)
                elif tag in BLOCK:
                    at = next((i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == tag), 0)
                    if at:
                        flush()
                        del stack[at:]
            elif tag in RAW:
                lower = lower if lower is not None else html.lower()
                end = lower.find(f"</{tag}", place)
                place = len(html) if end < 0 else end
                close = html.find(">", place)
                place = len(html) if close < 0 else close + 1
            elif tag in SILENT:
                silent += 1
            elif tag == "a":
                links = 1
            elif tag == "br":
                said(" ")
            elif tag in BLOCK:
                flush()
                if tag == "body":
                    silent = 0  # an unclosed head ends here
                if tag in ENDS_P and self.tag[stack[-1]] == "p":
                    stack.pop()
                if tag in SAME:
                    for i in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[i]] in SCOPE[tag]:
                            break
                        if self.tag[stack[i]] in SAME[tag]:
                            del stack[i:]
                            break
                if tag not in VOID and tag != "html":
                    self.tag.append(tag)
                    self.parent.append(stack[-1])
                    self.names.append(names(match[3] or match[6] or ""))
                    stack.append(len(self.tag) - 1)
            match = _TOKEN.search(html, place)
        said(html[place:])
        flush()

    def features(self) -> np.ndarray:
        n = len(self.tag)
        chars, linked, count, marks, tags = [0] * n, [0] * n, [0] * n, [0] * n, [1] * n
        first = [None] * n
        before, total = 0, sum(len(t) for _, t, _ in self.blocks) or 1
        for owner, text, inside in self.blocks:
            chars[owner] += len(text)
            linked[owner] += inside
            count[owner] += 1
            marks[owner] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            if first[owner] is None:
                first[owner] = before
            before += len(text)
        kids, width, paragraphs = [0] * n, [0] * n, [int(t == "p") for t in self.tag]
        for v in range(n - 1, 0, -1):
            u = self.parent[v]
            chars[u] += chars[v]
            linked[u] += linked[v]
            count[u] += count[v]
            marks[u] += marks[v]
            tags[u] += tags[v]
            paragraphs[u] += paragraphs[v]
            width[u] += 1
            if first[v] is not None:
                first[u] = first[v] if first[u] is None else min(first[u], first[v])
        rows = np.zeros((n, len(TAGS) + 20))
        depth, good_above, bad_above, yes_above, no_above = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        self.chars = chars
        for v in range(n):
            u, tag = self.parent[v], self.tag[v]
            good = sum(w in GOOD for w in self.names[v])
            bad = sum(w in BAD for w in self.names[v])
            if u >= 0:
                depth[v] = depth[u] + 1
                good_above[v], bad_above[v], yes_above[v], no_above[v] = good_above[u], bad_above[u], yes_above[u], no_above[u]
                kids[u] += 1
            rows[v, _PLACE.get(_KIND.get(tag, tag), len(TAGS) - 1)] = 1
            c, b = chars[v], count[v]
            rows[v, len(TAGS) :] = (
                good, bad, good_above[v], bad_above[v], yes_above[v], no_above[v],
                min(c, 2000), linked[v] / (c or 1), c / tags[v], b, c / (b or 1), marks[v] / (c or 1) * 100,
                depth[v], kids[u] if u >= 0 else 0, width[u] if u >= 0 else 0, c / (chars[u] or 1) if u >= 0 else 1,
                paragraphs[v], (first[v] or 0) / total, c / total, width[v],
            )
            good_above[v] += good
            bad_above[v] += bad
            yes_above[v] += tag in YES_TAGS
            no_above[v] += tag in NO_TAGS
        return rows

    def decode(self, p: np.ndarray) -> list[str]:
        """The kept blocks of the cheapest consistent choice."""
        n = len(self.tag)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        filled = np.array(self.chars) > 0
        keep = np.where(filled, -np.log(p), 0.0).tolist()
        drop = np.where(filled, -np.log(1 - p), 0.0).tolist()
        # A block that stands in a mixed element follows that element's own odds.
        own = [0] * n
        for owner, _, _ in self.blocks:
            own[owner] = 1
        mixed = [0.7 + min(k, d) * o if f else 0.0 for k, d, o, f in zip(keep, drop, own, filled)]
        alone = [k <= d for k, d in zip(keep, drop)]
        best: list[int] = [0] * n
        for v in range(n - 1, -1, -1):
            costs = (keep[v], drop[v], mixed[v])
            best[v] = min((1, 0, 2), key=costs.__getitem__)
            if v:
                u = self.parent[v]
                keep[u] += keep[v]
                drop[u] += drop[v]
                mixed[u] += costs[best[v]]
        for v in range(1, n):
            if best[self.parent[v]] != 2:
                best[v] = best[self.parent[v]]
        return [text for owner, text, _ in self.blocks if best[owner] == 0 or (best[owner] == 2 and alone[owner])]


class Trees:
    """Boosted regression trees on the logistic loss, by histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)])
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(ROUNDS if len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._walk(tree, x)

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray):
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        rows = {0: np.arange(len(g))}
        for node in range(size):
            r = rows.pop(node, None)
            if r is None:
                continue
            value[node] = RATE * g[r].sum() / (h[r].sum() + 1)
            if node >= 2**DEPTH - 1 or len(r) < 20:
                continue
            whole = g[r].sum() ** 2 / (h[r].sum() + 1)
            gain, where = 1e-6, None
            for f, edges in enumerate(self.edges):
                if len(edges) == 0:
                    continue
                b = binned[r, f]
                gs, hs = np.bincount(b, g[r], len(edges) + 1).cumsum()[:-1], np.bincount(b, h[r], len(edges) + 1).cumsum()[:-1]
                gains = gs**2 / (hs + 1) + (g[r].sum() - gs) ** 2 / (h[r].sum() - hs + 1) - whole
                i = int(gains.argmax())
                if gains[i] > gain:
                    gain, where = gains[i], (f, i)
            if where:
                feature[node], cut[node] = where[0], self.edges[where[0]][where[1]]
                left = binned[r, where[0]] <= where[1]
                rows[2 * node + 1], rows[2 * node + 2] = r[left], r[~left]
        return feature, cut, value

    @staticmethod
    def _walk(tree, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, each = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(DEPTH):
            f = feature[node]
            down = 2 * node + 1 + (x[each, np.maximum(f, 0)] > cut[node])
            node = np.where(f >= 0, down, node)
        return value[node]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self._walk(tree, x)
        return 1 / (1 + np.exp(-score))


# Training pages ---------------------------------------------------------------


def semantic(page: Page) -> list[bool] | None:
    """For each block whether the page's own elements call it article text; None if they don't say."""
    inside, out = [False] * len(page.tag), [False] * len(page.tag)
    for v in range(len(page.tag)):
        u, tag = page.parent[v], page.tag[v]
        if u >= 0:
            inside[v], out[v] = inside[u], out[u]
        inside[v] |= tag in YES_TAGS
        out[v] |= tag in NO_TAGS or any(w in BAD for w in page.names[v])
    return [inside[o] and not out[o] for o, _, _ in page.blocks] if any(inside) else None


def dressed(lines: list[str], other: list[str], draw: random.Random) -> tuple[str, list[bool]]:
    """A made-up layout around known article lines, and which of its blocks are article lines."""
    pick, chance = draw.choice, draw.random
    parts: list[str] = []
    truth: list[bool] = []
    short = lambda: escape(" ".join(pick(other).split()[: draw.randint(1, 4)])) or "x"
    long = lambda: escape(pick(other)) or "x"

    def wrap(bad: list[str], tag: str) -> tuple[str, str]:
        name = pick(bad)
        kind = pick(["class", "id"])
        return pick([(f"<{tag}>", f"</{tag}>"), (f'<div {kind}="{name}">', "</div>"), (f'<section {kind}="{name} x{draw.randint(1, 9)}">', "</section>"), (f'<{tag} class="{name}">', f"</{tag}>")])

    def noise(kind: str) -> None:
        if kind == "menu":
            a, b = wrap(["nav", "menu", "main-menu", "site-nav", "breadcrumb"], "nav")
            items = [short() for _ in range(draw.randint(2, 9))]
            parts.append(a + "<ul>" + "".join(f'<li><a href="/x">{i}</a></li>' for i in items) + "</ul>" + b)
            truth.extend([False] * len(items))
        elif kind == "form":
            a, b = wrap(["newsletter-signup", "search-form", "login"], "form")
            parts.append(f"{a}<p>{short()}</p><input name=q><button>{short()}</button>{b}")
            truth.append(False)
        elif kind == "comments":
            a, b = wrap(["comments", "comment-list", "replies", "discussion"], "aside")
            many = draw.randint(1, 5)
            inner = pick(["p", "li", "div"])
            parts.append(a + f"<h3>{short()}</h3>" + "".join(f'<{inner} class="comment">{long()}</{inner}>' for _ in range(many)) + b)
            truth.extend([False] * (many + 1))
        else:
            named = {"header": (["header", "masthead", "site-header", "top-banner"], "header"), "footer": (["footer", "site-footer", "copyright"], "footer"), "side": (["sidebar", "side widget", "related"], "aside"), "notice": (["cookie-notice", "consent", "alert banner"], "aside"), "ad": (["ad", "advert", "sponsored", "promo"], "aside")}[kind]
            a, b = wrap(*named)
            many = draw.randint(1, 3)
            parts.append(a + "".join(pick([f"<p>{long()}</p>", f"<div>{short()} <a href='/y'>{short()}</a></div>"]) for _ in range(many)) + b)
            truth.extend([False] * many)

    for kind in draw.sample(["header", "menu", "notice", "ad", "form"], draw.randint(1, 4)):
        noise(kind)
    a, b = pick([("<article>", "</article>"), ("<main>", "</main>"), ('<main><article class="post">', "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"), ('<div class="post entry">', "</div>"), ('<section class="article-body">', "</section>"), ("<div>", "</div>"), ('<td class="text">', "</td>")])
    parts.append(a)
    for i, line in enumerate(lines):
        if i and chance() < 0.08:
            noise(pick(["ad", "side", "form", "notice"]))
        parts.append(f"<h2>{escape(line)}</h2>" if i == 0 and chance() < 0.5 else pick([f"<p>{escape(line)}</p>", f"<p>{escape(line)}", f"<li>{escape(line)}</li>" if chance() < 0.2 else f"<p>{escape(line)}</p>"]))
        truth.append(True)
    if chance() < 0.3:
        noise("comments")
    parts.append(b)
    for kind in draw.sample(["side", "comments", "menu", "ad", "footer", "footer"], draw.randint(1, 4)):
        noise(kind)
    return "<html><body>" + "".join(parts) + "</body></html>", truth


def node_labels(page: Page, truth: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Share of article text below each element, and whether there is any text."""
    good, every = np.zeros(len(page.tag)), np.zeros(len(page.tag))
    for (owner, text, _), y in zip(page.blocks, truth):
        good[owner] += len(text) * y
        every[owner] += len(text)
    for v in range(len(page.tag) - 1, 0, -1):
        good[page.parent[v]] += good[v]
        every[page.parent[v]] += every[v]
    return good / np.maximum(every, 1), every > 0


def fit(pages: DataFrame, html_col: str = "html") -> Trees:
    """Trees from a bounded sample of pages, drawn by hash."""
    usable = pages.select(col(html_col).alias("html")).where("html is not null and html != ''").where(F.octet_length("html") <= LONGEST)
    # Three times as many as wanted are drawn by hash, so the tasks send few pages to be ordered.
    draw, parts = F.pmod(F.xxhash64(F.lit(29), "html"), F.lit(1 << 30)), 1 << 30
    drawn = usable.where(draw < min(parts, 3 * PAGES * parts // max(1, usable.count()))).distinct()
    rows = drawn.orderBy(draw, "html").limit(PAGES).collect()
    draw = random.Random(13)
    read = [Page(r["html"]) for r in rows]
    labelled = [(page, truth) for page in read if (truth := semantic(page)) is not None]
    articles = [[t for (_, t, _), y in zip(page.blocks, truth) if y] for page, truth in labelled]
    articles += [[t for _, t, _ in page.blocks if len(t) > 80] for page in read if semantic(page) is None]
    articles = [a for a in articles if a] or [["A plain sentence, long enough to read as text of an article, stands here.", "Another one follows it, with a little more to say about the matter."]]
    lines = [line for a in articles for line in a]
    sets = list(labelled)
    for article in articles:
        for _ in range(LAYOUTS):
            html, truth = dressed(article[: draw.randint(1, 30)], lines, draw)
            page = Page(html)
            if len(page.blocks) == len(truth):
                sets.append((page, truth))
    xs, ys = [], []
    for page, truth in sets:
        share, filled = node_labels(page, truth)
        chosen = filled & ((share < 0.1) | (share > 0.9))
        xs.append(page.features()[chosen])
        ys.append((share > 0.5)[chosen])
    return Trees(np.vstack(xs), np.concatenate(ys).astype(float))


def extract(pages: DataFrame, trees: Trees, html_col: str = "html", as_col: str = "main_text") -> DataFrame:
    """The pages with ``as_col``: the kept blocks, one a line."""
    shipped = pages.sparkSession.sparkContext.broadcast(trees)  # fixed by ROUNDS and DEPTH

    def run(htmls: list) -> list[str]:
        read = [Page(h) for h in htmls]
        rows = [page.features() for page in read]
        p = shipped.value.probability(np.vstack(rows)) if rows else np.zeros(0)
        ends = np.cumsum([len(r) for r in rows])
        return ["\n".join(page.decode(part)) for page, part in zip(read, np.split(p, ends[:-1]))]

    return with_values(pages, html_col, as_col, "string", pa.string(), run, rows=64)
