"""Main text of HTML pages: boosted trees over DOM-node features, decoded along the tree.

Block elements and runs of text are the nodes. Boosted trees give each the
probability that all text below it is main text, that none is, or that it
is mixed, from its size, link and tag density, place, neighbours, depth, and
from the words of its attributes and of its ancestors'. A node's state binds what is
below it: below a kept node all is kept, below a dropped one all is dropped,
and only a mixed one leaves it to its children. Among the states that do not
contradict one another the most likely are chosen, exactly, from the leaves up.

There are no labelled pages, so the trees are trained on pages whose labels are known by
construction: the text of a bounded sample (``PAGES`` different pages, longer ones than
``LONGEST`` characters only if there are no others) is set into varied layouts of articles with menus, headers, footers, sidebars, notices,
adverts, forms and comments; the sampled pages that have an ``article`` or ``main`` element are
added with what stands inside as main text. All pages are extracted whole.

Scripts, styles and other hidden elements have no text. Character references are
decoded, white space in a block becomes one space, blocks are joined in page
order by a line end. A null or empty page, or one without main text, gives an empty text.
"""

from __future__ import annotations

import html as entities
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm import dom
from storylens.llm.common import map_columns
from storylens.llm.trees import Boosted

#: Different pages of the training sample; pages beyond so many characters come last, while all have at most PAGES * LONGEST.
PAGES, LONGEST = 240, 100_000
#: Layouts that the text of a sampled page is set into; more of them if the pages are few, PAGES in all at least.
LAYOUTS = 2
#: Paragraphs of the layouts if no sampled page has any text. (fixed value)
EXAMPLE = ["The first boats left the harbour before dawn, and by noon the whole town, it seemed, had come down to the water.",
           "Nobody could say how long the bridge had stood there. It was older than the road, older than the two villages.",
           "In the years that followed, the garden was planted again, the walls were mended, and the gate was painted green."]
SEED = 6
KEEP, DROP, MIXED = 0, 1, 2
MARK = "\ue000"
#: Pages whose nodes are scored at once.
BATCH = 128

# Attributes of the layouts (fixed values)
MAIN = ["<article>", "<main>", '<div class="content">', '<div class="post-body entry">', '<div id="story">',
        '<section class="text">', "<div>", '<div class="article-text">', '<div class="main-column">', '<div role="main">']
PARTS = {
    "menu": ["<nav>", '<div class="menu">', '<div id="navigation">', '<div class="nav navbar">', '<div class="topnav links">'],
    "path": ['<div class="breadcrumb">', "<nav>", '<div class="path">'],
    "header": ["<header>", '<div class="header">', '<div class="masthead">', '<div id="top">'],
    "footer": ["<footer>", '<div class="footer">', '<div id="bottom">', '<div class="copyright legal">'],
    "sidebar": ["<aside>", '<div class="sidebar">', '<div class="widget">', '<div id="right" class="side rail">'],
    "notice": ['<div class="cookie-notice">', '<div role="alert">', '<section class="consent banner">', '<div class="notice popup">',
               '<div class="warning">'],
    "advert": ['<div class="ad">', '<div class="advert">', '<div class="sponsored promo">', '<div id="ads-banner">',
               '<aside class="advertisement">'],
    "form": ["<form>", '<div class="subscribe newsletter">', '<form class="search">', '<form id="signup">'],
    "related": ['<div class="related">', '<section class="recommended more">', '<div class="read-next">'],
    "share": ['<div class="share social">', '<ul class="sharing">'],
    "comments": ['<div class="comments">', '<section id="comments">', '<div class="comment-list">', '<div id="disqus" class="replies">'],
}
PLAIN = ["<div>", '<div class="wrap">', '<div class="row">', '<div class="box">', '<section>']


def _end(opening: str) -> str:
    return f"</{opening[1:].split()[0].rstrip('>')}>"


class Layouts:
    """Pages in varied layouts from given paragraphs; main text runs begin with ``MARK``."""

    def __init__(self, rng: np.random.Generator, paragraphs: list[str]):
        self.rng = rng
        self.paragraphs = paragraphs
        self.words = [w for p in paragraphs for w in p.split()][:5000] or ["."]

    def one(self, of: list):
        return of[int(self.rng.integers(len(of)))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, least: int, most: int) -> str:
        n, at = int(self.rng.integers(least, most + 1)), int(self.rng.integers(len(self.words)))
        return entities.escape(" ".join(self.words[at:at + n]) or self.words[0])

    def links(self, n: int, most: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{self.some(1, most)}</a></li>' for _ in range(n)) + "</ul>"

    def part(self, kind: str) -> str:
        r, opening = self.rng, self.one(PARTS[kind])
        if self.chance(0.15):
            opening = self.one(PLAIN)
        if kind in ("menu", "path"):
            n = int(r.integers(3, 12))
            inner = self.links(n, 2) if self.chance(0.7) else " | ".join(f'<a href="/x">{self.some(1, 2)}</a>' for _ in range(n))
        elif kind == "header":
            inner = f'<h{r.integers(1, 4)}><a href="/">{self.some(1, 4)}</a></h2><p>{self.some(2, 8)}</p>'
        elif kind == "footer":
            inner = f"&copy; {self.some(1, 3)} &middot; {self.some(3, 25)}" + (self.links(4, 2) if self.chance(0.4) else "")
        elif kind == "sidebar":
            inner = f"<h3>{self.some(1, 4)}</h3>" + (self.links(5, 6) if self.chance(0.6) else f"<p>{self.some(5, 40)}</p>")
        elif kind == "notice":
            inner = f"<p>{self.some(6, 30)}</p><button>{self.some(1, 2)}</button>" if self.chance(0.6) else self.some(6, 30)
        elif kind == "advert":
            inner = self.some(4, 30) if self.chance(0.6) else f'<p><a href="http://x">{self.some(4, 20)}</a></p>'
        elif kind == "form":
            inner = f'<label>{self.some(1, 4)}</label><input type="text"><p>{self.some(3, 15)}</p><input type="submit">'
        elif kind == "related":
            inner = f"<h3>{self.some(1, 3)}</h3>" + self.links(4, 10)
        elif kind == "share":
            inner = "".join(f'<a href="#">{self.some(1, 1)}</a> ' for _ in range(4))
        else:
            inner = f"<h3>{self.some(1, 3)}</h3>" + "".join(
                f'<div class="comment"><b>{self.some(1, 2)}</b><p>{self.some(5, 60)}</p></div>' for _ in range(int(r.integers(1, 6))))
        return opening + inner + _end(opening)

    def main(self) -> str:
        own = [f"{MARK}{entities.escape(p)}" for p in self.paragraphs]
        parts = [f"<h{self.one([1, 1, 2])}>{MARK}{self.some(2, 12)}</h1>"] if self.chance(0.85) else []
        for p in own:
            if self.chance(0.06):
                parts.append(f"<h2>{MARK}{self.some(2, 8)}</h2>")
            kind = self.rng.random()
            if kind < 0.72:
                parts.append(f"<p>{p}</p>")
            elif kind < 0.82:
                parts.append(f"<p><b>{p}<br>")
            elif kind < 0.88:
                parts.append(f"<blockquote>{p}</blockquote>")
            elif kind < 0.94:
                parts.append("<ul>" + "".join(f"<li>{MARK}{self.some(3, 20)}</li>" for _ in range(3)) + f"</ul><p>{p}")
            else:
                parts.append(f'<div>{p} <a href="/y">{self.some(1, 3)}</a></div>')
            if self.chance(0.05):
                parts.append(self.part(self.one(["advert", "share", "form", "related", "notice"])))
        opening = self.one(MAIN)
        return opening + "".join(parts) + _end(opening)

    def page(self) -> str:
        before = [k for k, p in (("notice", 0.4), ("header", 0.5), ("menu", 0.8), ("path", 0.3), ("advert", 0.5), ("form", 0.2),
                                 ("sidebar", 0.25)) if self.chance(p)]
        after = [k for k, p in (("share", 0.3), ("related", 0.4), ("comments", 0.5), ("sidebar", 0.4), ("form", 0.3), ("advert", 0.4),
                                ("footer", 0.85)) if self.chance(p)]
        body = "".join(map(self.part, before)) + self.main() + "".join(map(self.part, after))
        for _ in range(int(self.rng.integers(0, 3))):
            wrap = self.one(PLAIN)
            body = wrap + body + _end(wrap)
        return f"<html><head><title>x</title></head><body>{body}</body></html>"


#: Elements and attribute words that a sampled page's own labels go by (fixed values)
INSIDE = frozenset("article main".split())
OUTSIDE = frozenset("aside footer form nav".split())
OUTSIDE_WORDS = frozenset("ad ads advert advertisement banner comment comments cookie footer menu nav navigation newsletter notice "
                          "promo related share sidebar social sponsored subscribe widget".split())


def own_labels(page: dom.Page) -> np.ndarray | None:
    """For each node whether it lies in the page's article; None for a page without."""
    state = [0] * len(page.tag)
    for i, (p, tag) in enumerate(zip(page.parent, page.tag)):
        state[i] = state[p] if p >= 0 else 0
        if tag in INSIDE and state[i] == 0:
            state[i] = 1
        if tag in OUTSIDE or OUTSIDE_WORDS.intersection(page.tokens[i]):
            state[i] = 2
    inside = np.array(state) == 1
    return inside if inside.any() else None


@dataclass
class Words:
    """Log-odds of main text below elements with a tag or an attribute word."""

    odds: dict[str, float]

    def of(self, tag: str, tokens: tuple[str, ...]) -> tuple[float, float, float]:
        own = [self.odds.get(t, 0.0) for t in tokens] or [0.0]
        return self.odds.get(f"<{tag}", 0.0), min(own), max(own)


def learn_words(pages: list[dom.Page], inside: list[np.ndarray]) -> Words:
    counts: dict[str, list[float]] = {}
    for page, own in zip(pages, inside):
        for i, tag in enumerate(page.tag):
            if tag == "#text":
                at, seen = page.parent[i], set()
                while at >= 0:
                    seen.update((f"<{page.tag[at]}", *page.tokens[at]))
                    at = page.parent[at]
                for t in seen:
                    counts.setdefault(t, [0, 0])[int(not own[i])] += 1
    total = np.sum(list(counts.get("<#page", [1, 1])), axis=0) or 1
    share = counts.get("<#page", [1, 1])[0] / total
    return Words({t: float(np.log((m + 2 * share) / (o + 2 * (1 - share)) * (1 - share + 1e-6) / (share + 1e-6)))
                  for t, (m, o) in counts.items()})


def features(pages: list[dom.Page], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all nodes; the ends of their subtrees, and their parents, as numbers in the batch."""
    first = np.cumsum([0] + [len(p.tag) for p in pages])
    n = int(first[-1])
    parent = np.concatenate([np.array(p.parent, np.int64) + np.where(np.array(p.parent) >= 0, a, 0) for p, a in zip(pages, first)])
    parent_list = parent.tolist()
    end = list(range(1, n + 1))
    for i in range(n - 1, -1, -1):
        p = parent_list[i]
        if p >= 0 and end[i] > end[p]:
            end[p] = end[i]
    end = np.array(end)
    texts = [t for p in pages for t in p.text]
    tags = [t for p in pages for t in p.tag]
    leaf = np.fromiter((t == "#text" for t in tags), bool, n)
    chars = np.fromiter(map(len, texts), np.float64, n)
    count = np.fromiter((t.count(" ") + 1 if t else 0 for t in texts), np.float64, n)
    marks = np.fromiter((t.count(".") + t.count(",") for t in texts), np.float64, n)
    rights = np.fromiter(("\xa9" in t for t in texts), np.float64, n)
    linked = np.concatenate([np.array(p.linked, np.float64) for p in pages])
    inline = np.concatenate([np.array(p.inline, np.float64) for p in pages])
    controls = np.concatenate([np.array(p.controls, np.float64) for p in pages])
    up = np.maximum(parent, 0)
    kinds = {k: np.fromiter((t == k for t in tags), bool, n) for k in ("p", "li")}
    start = np.arange(n)

    def below(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(x)))
        return sums[end] - sums[start]

    all_chars, all_links, runs = below(chars), below(linked), below(leaf.astype(float))
    safe = np.maximum(all_chars, 1)
    page_of = np.repeat(np.arange(len(pages)), np.diff(first))
    top = first[:-1][page_of]
    page_chars = np.maximum(all_chars[top], 1)
    before = np.concatenate(([0.0], np.cumsum(chars)))
    offset = (before[start] - before[top]) / page_chars
    # chains along the tree
    depth, low, high, place, siblings = [0] * n, [0.0] * n, [0.0] * n, [0] * n, [0] * n
    last_child = [-1] * n
    previous, following = [-1] * n, [-1] * n
    own = [words.of(t, k) for p in pages for t, k in zip(p.tag, p.tokens)]
    for i, p in enumerate(parent_list):
        tag_odds, least, most = own[i]
        if p >= 0:
            depth[i], place[i] = depth[p] + 1, siblings[p]
            siblings[p] += 1
            low[i], high[i] = min(low[p], tag_odds, least), max(high[p], tag_odds, most)
            if last_child[p] >= 0:
                previous[i], following[last_child[p]] = last_child[p], i
            last_child[p] = i
        else:
            low[i], high[i] = min(0.0, least), max(0.0, most)
    previous, following = np.array(previous), np.array(following)
    siblings, place = np.array(siblings)[up], np.array(place)
    ratio = all_links / safe

    def beside(x: np.ndarray, other: np.ndarray) -> np.ndarray:
        return np.where(other >= 0, x[np.maximum(other, 0)], -1.0)

    log_chars = np.log1p(all_chars)
    own = np.array(own)
    columns = [
        depth, place, siblings, place / np.maximum(siblings, 1), log_chars, ratio, (end - start + below(inline)) / safe,
        all_chars / page_chars, below(marks) / safe, all_chars / np.maximum(runs, 1), below(count) / np.maximum(runs, 1),
        below(chars * kinds["p"][up]) / safe, below(chars * kinds["li"][up]) / safe, below(controls), own[:, 0], own[:, 1],
        own[:, 2], low, high, own[up, 0], own[up, 1], own[up, 2], offset, offset + all_chars / page_chars,
        beside(ratio, previous), beside(ratio, following), beside(log_chars, previous), beside(log_chars, following),
        log_chars[up], all_chars / np.maximum(all_chars[up], 1), ratio[up], below(rights) > 0, leaf, runs,
    ]
    return np.column_stack([np.asarray(c, np.float32) for c in columns]), end, parent


def states(inside: np.ndarray, end: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Each node's state by the main text below it."""
    main = np.concatenate(([0], np.cumsum(inside & leaf)))
    runs = np.concatenate(([0], np.cumsum(leaf)))
    start = np.arange(len(end))
    kept, all_ = main[end] - main[start], runs[end] - runs[start]
    return np.where(kept == 0, DROP, np.where(kept == all_, KEEP, MIXED))


def decode(log_p: np.ndarray, parent: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """The kept leaves of the most likely states that don't contradict one another."""
    keep, drop, mixed = (log_p[:, c].tolist() for c in (KEEP, DROP, MIXED))
    up, leaves, n = parent.tolist(), leaf.tolist(), len(parent)
    for i in range(n - 1, -1, -1):  # children come after their parents
        if leaves[i]:
            mixed[i] = -1e18
        p = up[i]
        if p >= 0:
            keep[p] += keep[i]
            drop[p] += drop[i]
            mixed[p] += max(keep[i], drop[i], mixed[i])
    state = [DROP] * n
    for i in range(n):
        p = up[i]
        if p >= 0 and state[p] != MIXED:
            state[i] = state[p]
        elif mixed[i] > keep[i] and mixed[i] > drop[i]:
            state[i] = MIXED
        else:
            state[i] = KEEP if keep[i] >= drop[i] else DROP
    return np.array([s == KEEP and x for s, x in zip(state, leaves)], bool)


@dataclass
class Extractor:
    words: Words
    trees: Boosted

    def texts(self, sources: list[str]) -> list[str]:
        out = []
        for k in range(0, len(sources), BATCH):
            pages = [dom.read(s) for s in sources[k:k + BATCH]]
            x, _, parent = features(pages, self.words)
            leaf = np.fromiter((t == "#text" for p in pages for t in p.tag), bool, len(parent))
            kept = decode(self.trees.log_probabilities(x), parent, leaf)
            at = 0
            for p in pages:
                out.append("\n".join(t for t, own in zip(p.text, kept[at:at + len(p.text)]) if own))
                at += len(p.text)
        return out


def train(sources: list[str], seed: int = SEED) -> Extractor:
    """An extractor from the text of some pages; from ``EXAMPLE`` if they have none."""
    read = [(page, own_labels(page)) for page in map(dom.read, sources)]
    texts: dict[int, list[str]] = {}
    for number, (page, own) in enumerate(read):
        leaves = [i for i, t in enumerate(page.tag) if t == "#text" and (own is None or own[i])]
        paragraphs = [page.text[i] for i in leaves if own is not None or (page.linked[i] * 2 < len(page.text[i]))]
        if paragraphs:
            texts[number] = paragraphs
    if not texts:  # any text will do
        texts = {n: some for n, (page, _) in enumerate(read) if (some := [t for t in page.text if t])} or {len(read): EXAMPLE}
    layouts = max(LAYOUTS, -(-PAGES // len(texts)))
    pages, inside = [], []
    for number in range(len(read) + 1):
        if number < len(read) and read[number][1] is not None:
            pages.append(read[number][0])
            inside.append(read[number][1])
        if number not in texts:
            continue
        rng = np.random.Generator(np.random.PCG64([seed, number]))
        for _ in range(layouts):
            made = dom.read(Layouts(rng, texts[number][:int(rng.integers(1, 25))]).page())
            inside.append(np.array([MARK in t for t in made.text]))
            made.text = [t.replace(MARK, "") for t in made.text]
            pages.append(made)
    words = learn_words(pages, inside)
    x, end, parent = features(pages, words)
    leaf = np.fromiter((t == "#text" for p in pages for t in p.tag), bool, len(parent))
    return Extractor(words, Boosted(x, states(np.concatenate(inside), end, leaf), 3))


def fit(pages: DataFrame, html_col: str = "html", sample: int = PAGES) -> Extractor | None:
    """Train on ``sample`` different pages, those of the smallest hashes; None if no page has a character.

    If fewer are of at most ``LONGEST`` characters, the shortest longer ones follow.
    """
    hashed = F.xxhash64(html_col, F.lit("extraction"))
    some = pages.where(F.length(html_col) >= 1)
    rows = (some.select(hashed.alias("hash"), F.greatest(F.length(html_col), F.lit(LONGEST)).alias("size")).distinct()
            .orderBy("size", "hash").limit(sample).collect())
    if not rows:
        return None
    upto = np.cumsum([r["size"] for r in rows]) <= sample * LONGEST
    chosen = [r.hash for i, r in enumerate(rows) if upto[i] or i == 0]
    found = some.where(hashed.isin(chosen)).select(F.col(html_col).alias("html")).distinct().collect()  # the bounded sample
    return train(sorted(r.html for r in found))


def extract(pages: DataFrame, extractor: Extractor | None, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Append the main text."""
    if extractor is None:
        return pages.withColumn(out_col, F.lit(""))
    shared = pages.sparkSession.sparkContext.broadcast(extractor)

    def make():
        own = shared.value
        return lambda sources: [own.texts([s or "" for s in sources])]

    return map_columns(pages, [html_col], f"`{out_col}` string", make)
