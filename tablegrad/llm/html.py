"""Main-text extraction: boosted trees over DOM-node features, and a hierarchical decoding.

A page is cut into a tree of elements (implied ends of p, li, cells and so on are honoured, raw-text elements are
skipped whole, a broken last tag is dropped). Each element gets a row of features: subtree text density and link share,
attribute tokens of its own and of its ancestors, depth, sibling statistics, tag classes. Trees give its log-odds of
holding article text. Decoding then labels all elements at once: the labelling with the largest summed log-odds in which
nothing below a dropped element is kept, found bottom-up in linear time.

The trees learn from weak labels of a bounded sample of the pages themselves (``MAX_PAGES``, those with the smallest url
hashes): text under ``article`` or ``main`` and not under navigation and the like is content. Part of the sample is
changed first (semantic tags renamed to plain ones, attributes dropped, unmarked navigation kept), so that the trees also
learn densities and sibling statistics; ``_teaching_pages`` adds small fixed layouts (comments, forms, notices) whose
texts are taken from the sampled pages. Where no sampled page has such tags, paragraphs, headings and items with few links and
no marks of navigation teach what content is, and elements that are mostly links or so marked what isn't.

Defined results: null, empty or text-less html gives an empty text; markup cut off anywhere is read as far as it goes;
repeated rows are extracted each; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbt
from .common import column, hash_share, pieces

#: Bound on the pages that the trees learn from, and on the elements of one page that do (evenly chosen from all that are labelled).
MAX_PAGES, MAX_ELEMENTS = 1500, 48

# Fixed sets of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIP = set("head script style noscript template textarea select option button svg math iframe object canvas audio video title datalist".split())
RAW = set("script style textarea title noscript iframe template svg math".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
             "time tt u var img br wbr input".split())
CLOSED_BY = {"p": set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                      "menu nav ol p pre section table ul".split()),
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}}
BOILER_TAGS = {"nav", "aside", "footer", "header", "form", "menu", "dialog", "fieldset"}
MAIN_TAGS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TEXT_TAGS = HEADINGS | set("p blockquote pre li td dd dt figcaption".split())
BOILER_WORDS = set("ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu submenu breadcrumb breadcrumbs "
                   "sidebar side aside rail widget footer foot header masthead top topbar cookie cookies consent gdpr notice notices alert popup modal overlay "
                   "comment comments commentlist reply replies respond disqus discussion form login signin signup register subscribe subscription newsletter search "
                   "related recommended recommend more popular trending share sharing social follow tags pagination pager toolbar copyright legal disclaimer "
                   "complementary contentinfo".split())
MAIN_WORDS = set("article articlebody content contents entry post postcontent story main maincontent body text copy page".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^<>]*\Z|</?\Z""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Page:
    """The elements of a page in document order, and its pieces of text.

    ``tags[i]``, ``parent[i]``, ``words[i]`` (tokens of class, id and role); ``texts``: (element, string) in order, with
    element -1 where a block begins or ends.
    """

    __slots__ = ("tags", "parent", "words", "texts", "hidden")

    def __init__(self, html: str):
        self.tags, self.parent, self.words, self.texts, self.hidden = ["#root"], [-1], [()], [], [False]
        stack, at, n = [0], 0, len(html)
        skip = 0  # open elements whose text is never shown
        while at < n:
            m = _TOKEN.search(html, at)
            end = m.start() if m else n
            if end > at and not skip:
                self.texts.append((stack[-1], html[at:end]))
            if not m:
                break
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[k]] == tag:
                        self._end(stack, k)
                        skip = sum(self.tags[i] in SKIP for i in stack)
                        break
                    if tag in INLINE and self.tags[stack[k]] not in INLINE:
                        break
                continue
            for name, by in CLOSED_BY.items():
                if tag in by:
                    for k in range(len(stack) - 1, 0, -1):
                        t = self.tags[stack[k]]
                        if t == name:
                            self._end(stack, k)
                            skip = sum(self.tags[i] in SKIP for i in stack)
                            break
                        if t in SCOPE.get(name, ()) or (name == "p" and t not in INLINE):
                            break
            if tag == "body":  # ends an open head
                while len(stack) > 1 and self.tags[stack[-1]] != "html":
                    stack.pop()
                skip = 0
            i = len(self.tags)
            self.tags.append(tag)
            self.parent.append(stack[-1])
            found = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(attrs)} if attrs else {}
            self.words.append(tuple(w.lower() for k in ("class", "id", "role") if k in found for w in _NAMES.findall(found[k])))
            self.hidden.append(bool(attrs) and ("hidden" in attrs.split() or "display:none" in found.get("style", "").replace(" ", "")))
            if tag == "br":
                self.texts.append((stack[-1], " "))
            elif tag not in INLINE and tag not in SKIP:
                self.texts.append((-1, ""))
            if tag in VOID or attrs.endswith("/") and tag not in TEXT_TAGS and tag not in ("div", "span", "a"):
                continue
            stack.append(i)
            skip += tag in SKIP
            if tag in RAW:
                close = re.compile(f"</{tag}\\b[^>]*>?", re.I).search(html, at)
                at = close.start() if close else n

    def _end(self, stack: list[int], k: int) -> None:
        """Close the open elements from place ``k`` on."""
        if any(self.tags[i] not in INLINE and self.tags[i] not in SKIP for i in stack[k:]):
            self.texts.append((-1, ""))
        del stack[k:]


FEATURES = ("heading", "text_tag", "container", "inline", "boiler_tag", "main_tag", "in_boiler_tag", "in_main_tag", "boiler_word", "main_word",
            "in_boiler_word", "in_main_word", "hidden", "depth", "children", "sibling_index", "sibling_share", "same_tag_share", "same_tag_siblings",
            "log_own", "log_subtree", "subtree_share", "parent_share", "tag_density", "link_share", "parent_link_share", "stops", "words_per_block",
            "position", "after_main", "below_text_tags", "digits")


def _parent_sums(parent: list[int], own: np.ndarray) -> np.ndarray:
    """Sums over subtrees (children come after their parents)."""
    out = own.astype(float).tolist()
    for i in range(len(out) - 1, 0, -1):
        out[parent[i]] += out[i]
    return np.array(out)


def features(page: Page) -> np.ndarray:
    """One row for each element."""
    tags, parent = page.tags, page.parent
    n = len(tags)
    par = np.array(parent)
    up = np.maximum(par, 0)
    own, links, stops, digits, begin = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.full(n, -1.0)
    in_link = [False] * n
    depth = [0] * n
    flags = np.zeros((n, 12))
    same: dict[tuple[int, str], int] = {}
    children = [0] * n
    index = [0] * n
    for i in range(1, n):
        t, p = tags[i], parent[i]
        w = page.words[i]
        depth[i] = depth[p] + 1
        in_link[i] = in_link[p] or t == "a"
        index[i] = children[p]
        children[p] += 1
        same[p, t] = same.get((p, t), 0) + 1
        f = flags[i]
        f[0], f[1], f[3], f[4], f[5] = t in HEADINGS, t in TEXT_TAGS, t in INLINE, t in BOILER_TAGS, t in MAIN_TAGS
        f[2] = not (f[1] or f[3])
        f[6], f[7] = max(flags[p][6], f[4]), max(flags[p][7], f[5])
        if w:
            f[8], f[9] = any(x in BOILER_WORDS for x in w), any(x in MAIN_WORDS for x in w)
        f[10], f[11] = max(flags[p][10], f[8]), max(flags[p][11], f[9])
    total = 0.0
    for e, s in page.texts:
        if e < 0:
            continue
        k = len(s) - s.count(" ") - s.count("\n")
        if begin[e] < 0:
            begin[e] = total
        own[e] += k
        total += k
        links[e] += k if in_link[e] else 0
        stops[e] += s.count(".") + s.count(",") + s.count(";")
        digits[e] += sum(map(s.count, "0123456789"))
    sub, link, dots, nums = (_parent_sums(parent, x) for x in (own, links, stops, digits))
    tags_below = _parent_sums(parent, np.ones(n))
    text_tags = _parent_sums(parent, flags[:, 1])
    blocks = _parent_sums(parent, (own > 0) & (flags[:, 3] == 0))
    start = begin.copy()
    for i in range(n - 1, 0, -1):
        if start[i] >= 0 and (start[up[i]] < 0 or start[up[i]] > start[i]):
            start[up[i]] = start[i]
    start[start < 0] = 0
    main_at = [i for i in range(n) if flags[i][5]]
    last_main = start[main_at[-1]] + sub[main_at[-1]] if main_at else -1.0
    kids = np.array(children, float)
    twins = np.array([same.get((parent[i], tags[i]), 1) for i in range(n)], float)
    ratio = lambda a, b: a / np.maximum(b, 1)
    share = ratio(link, sub)
    return np.column_stack([
        flags, page.hidden, depth, kids, index, ratio(np.array(index, float), kids[up]), ratio(twins, kids[up]), twins, np.log1p(own), np.log1p(sub),
        ratio(sub, total), ratio(sub, sub[up]), ratio(tags_below, sub / 100), share, share[up], ratio(dots, sub / 100), ratio(sub, blocks),
        ratio(start, total), (last_main >= 0) & (start >= last_main), text_tags, ratio(nums, sub)])


def decode(page: Page, log_odds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which elements are kept: the best labelling in which nothing below a dropped element is kept.

    An element counts with its own text (its log-odds times the square root of its length), so empty wrappers hardly
    decide anything.
    """
    weight = log_odds * np.sqrt(own)
    n = len(weight)
    keep, drop = weight.tolist(), (-weight).tolist()
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    out = np.zeros(n, bool)
    out[0] = True
    for i in range(1, n):
        out[i] = out[page.parent[i]] and keep[i] > drop[i]
    return out


def own_lengths(page: Page) -> np.ndarray:
    own = np.full(len(page.tags), 0.01)
    for e, s in page.texts:
        if e >= 0:
            own[e] += len(s) - s.count(" ") - s.count("\n")
    return own


def assemble(page: Page, kept: np.ndarray) -> str:
    """The kept texts: character references decoded, white space folded, one line a block."""
    lines, held = [], []
    for e, s in page.texts:
        if e < 0:
            lines.append("".join(held))
            held = []
        elif kept[e]:
            held.append(s)
    lines.append("".join(held))
    folded = (_SPACE.sub(" ", unescape(x)).strip() for x in lines)
    return "\n".join(x for x in folded if x)


def weak_labels(page: Page) -> np.ndarray:
    """1 for elements with content text below them, 0 for others, -1 where the page doesn't tell."""
    n = len(page.tags)
    main, boiler = [False] * n, [False] * n
    for i in range(1, n):
        p = page.parent[i]
        main[i] = main[p] or page.tags[i] in MAIN_TAGS
        boiler[i] = boiler[p] or page.tags[i] in BOILER_TAGS or page.hidden[i] or any(w in BOILER_WORDS for w in page.words[i])
    own = own_lengths(page)
    good = _parent_sums(page.parent, np.array([main[i] and not boiler[i] for i in range(n)]) * own)
    if not any(main):
        return np.full(n, -1)
    bad = _parent_sums(page.parent, np.array([boiler[i] or not main[i] for i in range(n)]) * own)
    return np.where((good > 0.5) & ~np.array(boiler), 1, np.where(bad > 0.5, 0, -1))


def density_labels(page: Page) -> np.ndarray:
    """Labels for a page without semantic tags: 1 for text elements with few links and what is mostly made of them, 0 for elements
    that are mostly links or marked as something else, -1 for others."""
    n = len(page.tags)
    boiler, in_link = [False] * n, [False] * n
    for i in range(1, n):
        p = page.parent[i]
        boiler[i] = boiler[p] or page.tags[i] in BOILER_TAGS or page.hidden[i] or any(w in BOILER_WORDS for w in page.words[i])
        in_link[i] = in_link[p] or page.tags[i] == "a"
    own = own_lengths(page) - 0.01
    sub = _parent_sums(page.parent, own)
    share = _parent_sums(page.parent, own * np.array(in_link)) / np.maximum(sub, 1)
    boilers = np.array(boiler)
    text = np.array([t in TEXT_TAGS for t in page.tags])
    heading = np.array([t in HEADINGS for t in page.tags])
    good = text & ~boilers & (share <= 0.3) & ((sub >= 40) | (heading & (sub >= 5)))
    inside = good.copy()
    for i in range(1, n):
        inside[i] |= inside[page.parent[i]] and not boiler[i]
    made = _parent_sums(page.parent, own * inside)
    wraps = ~boilers & ~text & (made > 0.5 * sub) & (sub > 0)
    out = np.where(inside | wraps, 1, np.where((boilers | (share > 0.5)) & (sub > 0), 0, -1))
    out[0] = 1 if good.any() else -1
    return out


_RENAMED = (("article", "div"), ("main", "div"), ("nav", "div"), ("footer", "div"), ("aside", "div"), ("header", "div"))


def _changed(html: str, how: int) -> str:
    """The page with its semantic hints partly taken away."""
    if how in (1, 3):
        for a, b in _RENAMED[:2]:
            html = re.sub(rf"<(/?){a}\b", rf"<\1{b}", html, flags=re.I)
    if how in (2, 3):
        for a, b in _RENAMED[2:]:
            html = re.sub(rf"<(/?){a}\b", rf"<\1{b}", html, flags=re.I)
    return re.sub(r' (class|id|role)="[^"]*"', "", html) if how in (2, 4) else html


_SIDE = ("comments", "sidebar", "cookie-notice", "related-posts", "newsletter", "share", "banner", "comment-list")


def _teaching_pages(html: str, number: int) -> str:
    """The page with a fixed boilerplate element put in front of or behind its article, filled with its own text."""
    if number % 5 == 4:  # a short article
        a, e = html.find("<article"), html.find("</article>")
        html = html[:a] + "<p>".join(html[a:e].split("<p>")[:2 + number % 4]) + html[e:] if 0 <= a < e else html
    if number % 4 == 2:  # a bare page
        html = re.sub(r'<(nav|footer)\b.*?</\1>|<div class="ad">.*?</div>', "", html, flags=re.S)
    if number % 8 == 6:  # without a title
        html = re.sub(r"<h1>.*?</h1>", "", html, flags=re.S)
    paragraphs = re.findall(r"<p>([^<]{20,})</p>", html)[:3] or ["Text."]
    name = _SIDE[number % len(_SIDE)]
    inner = "".join(f"<p>{p}</p>" for p in paragraphs[:1 + number % 3])
    shapes = (f'<div class="{name}">{inner}</div>', f'<section id="{name}"><h3>{name}</h3>{inner}</section>', f"<aside>{inner}</aside>",
              f'<form action="/x"><label>Name</label><p>{paragraphs[0]}</p><input name="q"></form>',
              f'<ul class="{name}">' + "".join(f"<li><p>{p}</p></li>" for p in paragraphs) + "</ul>")
    put = shapes[number % len(shapes)]
    items = [" ".join(p.split()[:3 + 4 * (number % 3)]) for p in paragraphs]
    parts = ("<ul>" + "".join(f"<li>{p}</li>" for p in items) + "</ul>", "<ol>" + "".join(f"<li>{p}</li>" for p in items) + "</ol>",
             "<table>" + "".join(f"<tr><td>{p}</td><td>{len(p)}</td></tr>" for p in items) + "</table>", f"<blockquote>{paragraphs[0]}</blockquote>",
             f"<section><h2>{items[0]}</h2><p>{paragraphs[-1]}</p></section>", f"<figure><figcaption>{items[-1]}</figcaption></figure>", f"<pre>{items[0]}</pre>")
    html = html.replace("</h1>", "</h1>" + parts[number % 7], 1) if number % 4 == 3 else html
    html = html.replace("</article>", parts[number % 7] + parts[number % 5] + "</article>", 1) if number % 4 else html
    if number % 2:
        return html.replace("<article", put + "<article", 1)
    if number % 4:
        return html.replace("</article>", put + "</article>", 1)
    return html.replace("</article>", "</article>" + put, 1)


def train(pages: DataFrame, url_col: str = "url", html_col: str = "html", max_pages: int = MAX_PAGES) -> gbt.Trees:
    """Trees from at most ``max_pages`` pages; tasks turn them into features, the driver fits."""
    names = [f"f{i}" for i in range(len(FEATURES))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, ys, kinds = [], [], []

            def teach(kind: int, shown: Page, y: np.ndarray) -> None:
                use = np.flatnonzero(y >= 0)
                if len(shown.tags) != len(y) or not len(use):
                    return
                # long pages count with their wrappers and an even choice of their paragraphs
                use = use[np.unique(np.linspace(0, len(use) - 1, min(len(use), MAX_ELEMENTS)).astype(int))]
                xs.append(features(shown)[use])
                ys.append(y[use])
                kinds.extend([kind] * len(use))

            for h, k in zip(column(b, "_html").to_pylist(), column(b, "_k").to_pylist()):
                source = Page(_teaching_pages(h, k) if k % 3 else h)
                y = weak_labels(source)
                if not (y >= 0).any():
                    bare = Page(h)
                    teach(1, Page(_changed(h, 4 if k % 2 else 0)), density_labels(bare))
                    continue
                shown = _changed(_teaching_pages(h, k) if k % 3 else h, k % 5)
                if k % 7 == 3:  # the article's parts stand in the body itself
                    y = y[[t not in MAIN_TAGS for t in source.tags]]
                    shown = re.sub(r"</?(article|main)\b[^>]*>", "", _teaching_pages(h, k) if k % 3 else h)
                teach(0, Page(shown), y)
            if xs:
                x, y = np.concatenate(xs), np.concatenate(ys)
                yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int64)), pa.array(kinds), *map(pa.array, x.T.astype(float))], ["y", "kind", *names])

    some = pages.where(F.length(html_col) > 0)
    rows = some.select(F.col(html_col).alias("_html"), F.xxhash64(url_col, html_col).alias("_o")) \
        .where(hash_share(F.col("_o"), some.count(), max_pages)).groupBy("_o").agg(F.first("_html").alias("_html"))  # equal pages once
    sample = rows.orderBy("_o").limit(max_pages).select("_html", F.pmod("_o", F.lit(60)).cast("int").alias("_k"))
    got = sample.repartition(16).mapInArrow(run, "y bigint, kind bigint, " + ", ".join(f"{c} double" for c in names)).toArrow()
    x = np.stack([got[c].to_numpy() for c in names], 1) if len(got) else np.zeros((0, len(names)))
    y = got["y"].to_numpy().astype(float) if len(got) else np.zeros(0)
    if len(got):  # labels by density only where there are no others
        kind = got["kind"].to_numpy()
        x, y = x[kind == kind.min()], y[kind == kind.min()]
    order = np.lexsort((*x.T, y))
    return gbt.fit(x[order], y[order], trees=40, depth=4, rate=0.25)


def extract_text(html: str | None, trees: gbt.Trees) -> str:
    if not html:
        return ""
    page = Page(html)
    return assemble(page, decode(page, trees.margin(features(page)), own_lengths(page)))


def extract(pages: DataFrame, trees: gbt.Trees, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """The id, the columns ``keep`` and ``text`` of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(trees)
    cols = [id_col, *keep]
    schema = ", ".join(f"_{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in pieces(batches, "_html"):
            parsed = [Page(h) if h else None for h in column(rows, "_html").to_pylist()]
            shown = [p for p in parsed if p]
            tables = [features(p) for p in shown]
            odds = np.split(sent.value.margin(np.concatenate(tables)), np.cumsum([len(t) for t in tables])[:-1]) if tables else []
            texts = iter([assemble(p, decode(p, o, own_lengths(p))) for p, o in zip(shown, odds)])
            yield pa.RecordBatch.from_arrays([*(column(rows, f"_{i}") for i in range(len(cols))),
                                              pa.array([next(texts) if p else "" for p in parsed], pa.string())],
                                             [*(f"_{i}" for i in range(len(cols))), "text"])

    out = pages.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(cols)), F.col(html_col).alias("_html")).mapInArrow(run, f"{schema}, text string")
    return out.toDF(*cols, "text")
