"""Main-text extraction: gradient-boosted trees over DOM nodes and hierarchical decoding.

A page's elements get features: kind of tag, tokens of class, id and role, what
lies above them, depth, place among siblings, and text, link, mark and tag
density of their subtree. Trees give each element the probability that it
belongs to the article (or holds it). Decoding picks the likeliest choice of all
elements in which nothing is kept inside something dropped.

No table says which elements are content, so the trees learn from up to
``max_pages`` pages that name their article themselves (``article`` or ``main``),
as they are and in variants: the name is taken away or put into a class, and
menus, notices, adverts, forms, sidebars, footers and reader comments made of
other pages' texts are put around and into it.

Text runs end at block elements; in a run, white space becomes one blank; ``br``
is white space. Scripts, styles, templates, heads, titles, comments, ``noscript``,
``iframe``, drawings (``svg``) and form controls (``textarea``, ``select``,
``option``, ``button``, ``datalist``) hold no text. Formulas (``math``, cells and
annotations set apart by a blank) and what ``object`` and ``canvas`` hold are text.

Defined cases: null and empty html give an empty text; a page without elements is
one body with its text; unclosed and misnested tags are closed as browsers do; no
page to learn from: ``article`` and ``main`` decide, or else the whole body; null
page ids and repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.labelled import fitted

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg iframe textarea select option button datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var br wbr img object param canvas math semantics annotation annotation-xml maction menclose merror "
                   "mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup "
                   "mtable mtd mtext mtr munder munderover none".split())
APART = frozenset("annotation annotation-xml mtd mtr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre section summary table ul".split())
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
KINDS = [{"article", "main"}, {"section"}, {"div"}, {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "menu", "dl"},
         {"li", "dt", "dd"}, {"nav"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "label", "dialog"}, {"table", "tr", "td", "th", "tbody"}, {"a"}]
KIND_OF = {tag: i for i, kind in enumerate(KINDS) for tag in kind}
OTHER_WORDS = ("ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion sidebar side aside rail comment comments "
               "commentlist discussion disqus reply replies respond reader cookie cookies consent gdpr notice notices alert banner popup modal overlay "
               "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar header masthead footer foot copyright legal "
               "related recommended recommendations share sharing social subscribe subscription newsletter signup login search form widget widgets "
               "contentinfo complementary dialog skip hidden none tags teaser").split()
MAIN_WORDS = "article articlebody main content contents post entry story body text prose page".split()
OTHER, MAIN = frozenset(OTHER_WORDS), frozenset(MAIN_WORDS)

OPENING = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
TAG_PART = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-label|itemprop)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARKS = re.compile(r"[.,;:!?]")


@dataclass
class Page:
    """Elements in page order, and text runs as (element, text, starts a block)."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    places: list[int] = field(default_factory=list)
    flags: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    runs: list[tuple[int, str, bool]] = field(default_factory=list)


def attribute_flags(text: str) -> int:
    """Bit 0: a word of menus, notices and the like; bit 1: a word of main text."""
    out = 0
    for name, *values in ATTRIBUTE.findall(text) if text else ():
        value, name = "".join(values), name.lower()
        if name == "style":
            out |= "display:none" in value.replace(" ", "").lower()
            continue
        words = {w.lower() for w in PART.findall(value)} if name != "hidden" else {"hidden"}
        words.add(value.lower())
        out |= (1 if words & OTHER else 0) | (2 if words & MAIN else 0)
    return out


class Marks:
    """Where tags of a source end. Places from which no end was found are kept, so that a page is looked through a bounded number of times."""

    def __init__(self, source: str) -> None:
        self.source, self.dry, self.lost = source, len(source) + 1, set()

    def next_end(self, at: int) -> int:
        """The next ``>``, or -1."""
        if at >= self.dry:
            return -1
        end = self.source.find(">", at)
        if end < 0:
            self.dry = at
        return end

    def tag_end(self, at: int) -> int:
        """The next ``>`` outside quotes that begin at or after ``at``, or -1."""
        if self.next_end(at) < 0:
            return -1
        seen = []
        while True:
            m = TAG_PART.search(self.source, at) if at < self.dry else None
            place = m.start() if m else -1
            if m and m.group() == ">":
                return place
            other = self.source.find(m.group(), place + 1) if m and place not in self.lost else -1
            if other < 0:
                self.lost.update(seen, [place])
                return -1
            seen.append(place)
            at = other + 1


def parse(source: str) -> Page:
    page = Page()

    def start(tag: str, attributes: str) -> None:
        up = stack[-1] if stack else -1
        page.tags.append(tag)
        page.parents.append(up)
        page.ends.append(0)
        page.depths.append(len(stack))
        page.places.append(children[-1])
        children[-1] += 1
        flags = attribute_flags(attributes) | (4 << KIND_OF[tag] if tag in KIND_OF else 0)
        page.flags.append(flags)
        page.above.append(page.above[up] | page.flags[up] if up >= 0 else 0)
        stack.append(len(page.tags) - 1)
        names.append(tag)
        children.append(0)

    def close(depth: int) -> None:
        while len(stack) > depth:
            page.ends[stack.pop()] = len(page.tags)
            names.pop()
            children.pop()

    stack: list[int] = []
    names: list[str] = []
    children, silent, fresh, at = [0], 0, True, 0
    start("body", "")
    marks, unended = Marks(source), set()
    while at < len(source):
        if source[at] != "<":
            end = source.find("<", at)
            end = len(source) if end < 0 else end
            page.runs.append((stack[-1], source[at:end], fresh))
            fresh, at = False, end
            continue
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = len(source) if end < 0 else end + 3
            continue
        m = OPENING.match(source, at)
        if m:
            end = marks.tag_end(m.end())
        else:
            end = marks.next_end(at) if source[at + 1:at + 2] in ("!", "?") else -1
        if end < 0:  # no tag, or one that never ends
            page.runs.append((stack[-1], "<", fresh))
            fresh, at = False, at + 1
            continue
        closing, tag, attributes = (*m.groups(), source[m.end():end]) if m else (None, None, None)
        at = end + 1
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            fresh = True
            continue
        if closing:
            if tag in names[1:]:
                close(len(names) - 1 - names[::-1].index(tag))
            fresh = fresh or tag not in INLINE
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            fresh = fresh or tag not in INLINE
            continue
        if tag == "head" or tag in SILENT:
            end = None if tag in unended else re.compile(rf"</{tag}(?![^\s/>])[^>]*>?", re.I | re.A).search(source, at)
            if end:
                at = end.end()
            else:  # nor will a later one end
                unended.add(tag)
            continue
        if tag in CLOSES_P and "p" in names:
            close(len(names) - 1 - names[::-1].index("p"))
        if tag in SAME:
            ends, walls = SAME[tag]
            for i in range(len(names) - 1, 0, -1):
                if names[i] in walls:
                    break
                if names[i] in ends:
                    close(i)
                    break
        if tag in VOID:
            if tag in ("br", "wbr"):
                page.runs.append((stack[-1], " " if tag == "br" else "", fresh))
            elif tag not in INLINE:
                fresh = True
            continue
        fresh = fresh or tag not in INLINE
        if tag in APART:
            page.runs.append((stack[-1], " ", fresh))
        start(tag, attributes)
    close(0)
    return page


FEATURES = 2 + len(KINDS) + 2 + len(KINDS) + 14


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """A row for each element of all pages in a row, and where each page's rows begin."""
    first = np.cumsum([0, *(len(p.tags) for p in pages)])
    n = int(first[-1])
    base = np.repeat(first[:-1], np.diff(first))
    flat = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), np.int64, n)
    parents, ends, depths, places, flags, above = (flat(k) for k in ("parents", "ends", "depths", "places", "flags", "above"))
    own = np.zeros((4, n))
    link = 4 << KIND_OF["a"]
    for p, lo in zip(pages, first, strict=False):
        for node, text, _ in p.runs:
            size = len(text.strip())
            if size:
                k = lo + node
                own[0, k] += size
                own[1, k] += len(MARKS.findall(text))
                own[2, k] += size if (p.flags[node] | p.above[node]) & link else 0
                own[3, k] += 1
    sums = np.concatenate([np.zeros((5, 1)), np.cumsum(np.vstack([own, np.ones(n)]), 1)], 1)
    stop = ends + base
    text, marks, links, runs, tags = sums[:, stop] - sums[:, np.arange(n)]
    page_text = np.maximum(text[base], 1)
    up = np.where(parents < 0, np.arange(n), parents + base)
    siblings = np.bincount(up, minlength=n)
    before = (sums[0, np.arange(n)] - sums[0, base]) / page_text
    bits = [(flags >> i) & 1 for i in range(2 + len(KINDS))] + [(above >> i) & 1 for i in range(2 + len(KINDS))]
    x = np.stack([*bits, depths, places, siblings[up], places / np.maximum(siblings[up], 1), np.log1p(text), text / np.maximum(tags, 1),
                  marks / np.maximum(text, 1), links / np.maximum(text, 1), text / page_text, text / np.maximum(text[up], 1), before,
                  text / np.maximum(runs, 1), np.log1p(own[0]), tags], 1)
    return x.astype(np.float32), first


@dataclass
class Trees:
    """Boosted trees of a fixed depth on binned features; ``split`` and ``bin`` by tree and inner node, ``leaf`` by tree and leaf."""

    edges: list[np.ndarray]
    split: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1).astype(np.int16)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b, out, rows = self.binned(x), np.full(len(x), self.base), np.arange(len(x))
        for split, at, leaf in zip(self.split, self.bin, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (b[rows, split[node]] > at[node])
            out += leaf[node - len(split)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, l2: float = 1.0) -> Trees:
    """Newton boosting of the log loss, level by level over histograms."""
    edges = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:  # else every value has its own bin, however rare
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins)))
        edges.append((values[:-1] + values[1:]) / 2)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(edges, np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth)), float(np.log(share / (1 - share))))
    b = model.binned(x).astype(np.int64)
    score, width = np.full(len(x), model.base), bins + 1
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        split, at, node = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, width), np.zeros(len(x), np.int64)
        for level in range(depth):
            lo, many = 2 ** level - 1, 2 ** level
            gain = np.full((many, x.shape[1], width), -np.inf)
            for j in range(x.shape[1]):
                cell = (node - lo) * width + b[:, j]
                gl, hl = (np.bincount(cell, v, minlength=many * width).reshape(many, width).cumsum(1) for v in (g, h))
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain[:, j] = np.where((hl > 0.5) & (hr > 0.5), gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - gl[:, -1:] ** 2 / (hl[:, -1:] + l2), -np.inf)
            best = gain.reshape(many, -1).argmax(1)
            useful = gain.reshape(many, -1)[np.arange(many), best] > 1e-6
            split[lo:lo + many], at[lo:lo + many] = best // width, np.where(useful, best % width, width)
            node = 2 * node + 1 + (b[np.arange(len(x)), split[node]] > at[node])
        cell = node - len(split)
        leaf = -rate * np.bincount(cell, g, minlength=2 ** depth) / (np.bincount(cell, h, minlength=2 ** depth) + l2)
        score += leaf[cell]
        trees.append((split, at, leaf))
    model.split, model.bin, model.leaf = (np.stack(t) for t in zip(*trees, strict=True))
    return model


def decode(page: Page, odds: list[float]) -> list[bool]:
    """Which elements are kept: the likeliest choice in which no element is kept inside a dropped one."""
    n = len(odds)
    keep, drop = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        z = odds[i]
        soft = max(z, 0.0) + float(np.log1p(np.exp(-abs(z))))
        keep[i] += z - soft
        drop[i] += -soft
        up = page.parents[i]
        if up >= 0:
            keep[up] += max(keep[i], drop[i])
            drop[up] += drop[i]
    out = [False] * n
    for i in range(n):
        up = page.parents[i]
        out[i] = (True if up < 0 else out[up]) and keep[i] >= drop[i]
    return out


def text_of(page: Page, kept: list[bool]) -> str:
    blocks: list[list[str]] = []
    fresh = True
    for node, text, begins in page.runs:
        fresh = fresh or begins
        if kept[node]:
            if fresh:
                blocks.append([])
                fresh = False
            blocks[-1].append(text)
    joined = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(b for b in joined if b)


def _inside(page: Page) -> list[bool] | None:
    """What the page itself names as its article, with all that is above; nothing where it names none."""
    out, named = [False] * len(page.tags), False
    other = sum(4 << KIND_OF[t] for t in ("nav", "footer", "aside", "form", "header")) | 1
    for i, tag in enumerate(page.tags):
        up = page.parents[i]
        if tag in ("article", "main"):
            named = True
            out[i] = True
            while up >= 0:
                out[up] = True
                up = page.parents[up]
        elif page.above[i] & 4 and not (page.flags[i] & other) and up >= 0 and out[up]:
            out[i] = True
    return out if named else None


# What surrounds articles, as tag and class of a wrapper, and how it is filled.
AROUND = [("aside", "", "prose"), ("div", "sidebar", "links"), ("div", "sidebar", "prose"), ("div", "comments", "prose"), ("section", "comments", "prose"),
          ("ol", "comment-list", "items"), ("div", "comment", "prose"), ("div", "cookie-notice", "prose"), ("div", "notice", "prose"), ("div", "banner", "prose"),
          ("div", "ad", "prose"), ("div", "advert", "links"), ("header", "", "links"), ("header", "", "prose"), ("div", "header", "prose"), ("nav", "", "links"),
          ("div", "menu", "links"), ("ul", "breadcrumbs", "items"), ("form", "", "prose"), ("div", "newsletter", "prose"), ("div", "related", "links"),
          ("div", "share social", "links"), ("div", "footer", "prose"), ("footer", "", "links")]
NAMES = [("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' id="post-body"'), ("div", ""), ("section", ' class="story"')]
ARTICLE = re.compile(r"<(/?)article\b[^>]*>", re.I)


def _piece(rng: np.random.Generator, texts: list[str]) -> str:
    tag, name, fill = AROUND[rng.integers(len(AROUND))]
    pick = lambda: entities.escape(texts[rng.integers(len(texts))][:int(rng.integers(10, 400))])
    many = range(int(rng.integers(1, 7)))
    inner = {"prose": "".join(f"<p>{pick()}</p>" for _ in many), "items": "".join(f"<li>{pick()}</li>" for _ in many),
             "links": "<ul>" + "".join(f'<li><a href="/x">{pick()[:20]}</a></li>' for _ in many) + "</ul>"}[fill]
    named = f' class="{name}"' if name else ""
    return f"<{tag}{named}>{inner}</{tag}>"


def variants(source: str, texts: list[str], rng: np.random.Generator) -> Iterator[tuple[Page, list[bool]]]:
    """The page as it is and changed, each with the elements that belong to its article."""
    page = parse(source)
    own = _inside(page)
    if own is None:
        return
    yield page, own
    if len(ARTICLE.findall(source)) != 2 or not texts:
        return
    for _ in range(2):
        tag, attributes = NAMES[rng.integers(len(NAMES))]
        inner = "".join(_piece(rng, texts) for _ in range(rng.integers(0, 3)))
        before = "".join(_piece(rng, texts) for _ in range(rng.integers(0, 3)))
        after = "".join(_piece(rng, texts) for _ in range(rng.integers(0, 3)))
        wrap = rng.integers(2)
        marked = ARTICLE.sub(lambda m: f"{inner}</article>{after}" + "</div>" * wrap if m[1] else "<div>" * wrap + before + "<article>", source)
        renamed = ARTICLE.sub(lambda m: f"{inner}</{tag}>{after}" + "</div>" * wrap if m[1] else "<div>" * wrap + before + f"<{tag}{attributes}>", source)
        marked_page, renamed_page = parse(marked), parse(renamed)
        label = _inside(marked_page)
        if label is not None and len(marked_page.tags) == len(renamed_page.tags):
            yield renamed_page, label


def train(sample: pd.DataFrame, seed: int = 5) -> Trees | None:
    """Trees from pages (column text) that name their article; nothing if there is none."""
    rng = np.random.default_rng(seed)
    plain = [entities.unescape(re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", re.sub(r"(?is)<(script|style|title)\b.*?</\1>", " ", s)))).strip() for s in sample["text"]]
    texts = [t[int(k):] for t in plain if t for k in rng.integers(0, max(1, len(t) // 2), 2)]
    got = [v for s in sample["text"] for v in variants(s, texts, rng)]
    if not got:
        return None
    x, _ = features([p for p, _ in got])
    y = np.concatenate([np.array(label, float) for _, label in got])
    return boost(x, y) if 0 < y.mean() < 1 else None


def extract(sources: list[str], trees: Trees | None) -> list[str]:
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    x, first = features(pages)
    odds = trees.log_odds(x) if trees else np.zeros(len(x))
    out = []
    for i, page in enumerate(pages):
        if trees:
            mine = odds[first[i]:first[i + 1]].tolist()
            mine[0] = 50.0  # the body holds whatever there is
            kept = decode(page, mine)
        else:
            kept = _inside(page) or [True] * len(page.tags)
        out.append(text_of(page, kept))
    return out


def fit(pages: DataFrame, max_pages: int = 400) -> Trees | None:
    """Trees from at most ``max_pages`` pages that name their article, chosen by a hash."""
    named = pages.where(F.col("html").rlike(r"(?i)<(article|main)\b")).select(F.xxhash64("html").alias("doc_id"), F.col("html").alias("text"))
    sample = named.select("doc_id").distinct().orderBy("doc_id").limit(max_pages).join(named, "doc_id").dropDuplicates(["doc_id"])
    return fitted(sample.withColumn("y", F.lit(0)), train)


def main_texts(pages: DataFrame, max_pages: int = 400, at_once: int = 256) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    trees = fit(pages, max_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, at_once):
                part = batch.slice(lo, at_once)
                texts = extract([s or "" for s in part.column("html").to_pylist()], trees)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select("page_id", "url", "html")
    kinds = dict(narrow.dtypes)
    return narrow.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
