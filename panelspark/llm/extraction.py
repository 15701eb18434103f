"""Main text of web pages: boosted trees over page nodes, decoded along the hierarchy."""

from __future__ import annotations

import random
from functools import partial
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import boosting
from panelspark.llm.common import map_rows, slices
from panelspark.llm.dom import BOND, HIDDEN, Dom, Forest

GOOD = ["article", "main", 'div class="content"', 'div id="post-body"', 'section class="entry-content"', 'div class="story"', "div",
        'div class="main-text"', 'div role="main"', 'article class="post"']
#: tags and attributes of added blocks that are not main text, by kind
BAD = {
    "side": ["aside", 'div class="sidebar"', 'div id="right-rail"', 'section class="related-posts"', 'div class="widget"', 'aside class="more"'],
    "notice": ['div class="cookie-notice"', 'div id="consent"', 'div class="newsletter"', 'section class="notice"', 'div role="alert"', 'div class="popup"'],
    "ads": ['div class="ad"', 'div class="advert-box"', 'div id="sponsored"', 'aside class="ads"', 'p class="ad"'],
    "talk": ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="replies"', 'div id="disqus_thread"'],
    "top": ["header", 'div class="header"', 'div id="masthead"', 'header class="site-header"'],
    "foot": ["footer", 'div class="footer"', 'div id="site-footer"', 'div class="copyright"'],
    "menu": ["nav", 'ul class="menu"', 'div class="navbar"', 'div id="breadcrumbs"', 'nav class="toc"'],
    "form": ["form", 'form class="search"', 'div class="login-form"', 'form id="signup"'],
}


def _tag(spec: str, inner: str) -> str:
    return f"<{spec}>{inner}</{spec.split()[0]}>"


def page_lines(html: str) -> list[tuple[str, str]] | None:
    """(tag, text) of the blocks inside a page's article or main element; None without one."""
    forest = Forest([Dom(html)])
    inside = forest.above(np.array([[t in ("article", "main")] for t in forest.tags], bool).reshape(-1, 1))[:, 0]
    bad = forest.above(np.array([[t in ("nav", "aside", "footer", "form") or bool(set(g) - {0})] for t, g in zip(forest.tags, forest.groups)], bool).reshape(-1, 1))[:, 0]
    lines, last = [], None
    for i, t in enumerate(forest.tags):
        if t == "#text" and inside[i] and not bad[i]:
            if forest.block[i] != last:
                p = i
                while forest.tags[p] not in ("p", "h1", "h2", "h3", "li", "article", "main") and not forest.root[p]:
                    p = int(forest.parent[p])
                lines.append([forest.tags[p] if forest.tags[p] in ("h1", "h2", "h3", "li") else "p", ""])
                last = forest.block[i]
            lines[-1][1] += forest.texts[i]
    lines = [(t, " ".join(x.split())) for t, x in lines]
    return [x for x in lines if x[1]] or None


STAND_IN = [("p", "some words of a line that stand for the main text of a page")] * 4


def any_lines(html: str | None) -> list[str]:
    """The texts of a page's blocks, whatever they are."""
    forest = Forest([Dom(html)])
    return [x for x in forest.page_texts(np.ones(len(forest.tags), bool))[0].split("\n") if x]


def variant(lines: list[tuple[str, str]], pool: list[str], rng: random.Random) -> str:
    """A page of another make around the given blocks; every added block carries the attribute ``x-bad``."""
    pick = lambda: escape(rng.choice(pool))

    def extra(kind: str) -> str:
        spec = rng.choice(BAD[kind])
        name = spec.split()[0]
        if kind == "menu" or (kind in ("foot", "side") and rng.random() < 0.5):
            inner = "".join(f'<li><a href="/{k}">{escape(w)}</a></li>' for k, w in enumerate(pick().split()[:rng.randint(3, 8)]))
            inner = inner if name == "ul" else f"<ul>{inner}</ul>"
        elif kind == "form":
            inner = f'<label>{escape(" ".join(pick().split()[:3]))}</label><input name="q"><button>{escape(pick().split()[0])}</button>'
        elif kind == "talk":
            item = "li" if name == "ol" else "div"
            inner = "".join(f"<{item}><b>{escape(pick().split()[0])}</b><p>{pick()}</p></{item}>" for _ in range(rng.randint(1, 5)))
        elif kind == "foot":
            inner = f"&copy; {pick()}"
        elif name == "p" or rng.random() < 0.4:
            inner = pick()
        else:
            inner = f"<h3>{escape(' '.join(pick().split()[:4]))}</h3>" * rng.randint(0, 1) + "".join(f"<p>{pick()}</p>" for _ in range(rng.randint(1, 3)))
        return _tag(f"{name} x-bad=1{spec[len(name):]}", inner)

    blocks = []
    for t, x in lines:
        x = escape(x)
        cut = rng.random()
        blocks.append(f"<{t}><b>{x}<br>" if cut < 0.1 and t == "p" else f"<{t}>{x}" if cut < 0.2 and t == "p" else f"<{t}>{x}</{t}>")
        if rng.random() < 0.1:
            blocks.append(extra(rng.choice(["ads", "side", "notice", "form"])))
    core = _tag(rng.choice(GOOD), "\n".join(blocks))
    if rng.random() < 0.3:
        core = _tag(rng.choice(["div", 'div class="wrap"', 'div id="page"', "section"]), core)
    head = "".join(extra(k) for k in ("top", "menu", "notice", "ads", "form", "side") if rng.random() < 0.45)
    tail = "".join(extra(k) for k in ("talk", "side", "form", "menu", "ads", "notice", "foot") if rng.random() < 0.45)
    return f"<html><head><title>{pick()}</title></head><body>{head}{core}{tail}</body></html>"


class _Marked(Dom):
    """A page whose added blocks are marked: ``bad`` holds their nodes."""

    def __init__(self, html):
        self.bad: set[int] = set()
        super().__init__(html)

    def handle_starttag(self, tag, attrs):
        before = len(self.tag)
        super().handle_starttag(tag, [a for a in attrs if a[0] != "x-bad"])
        if any(a[0] == "x-bad" for a in attrs) and len(self.tag) > before:
            self.bad.add(len(self.tag) - 1)


def node_labels(forest: Forest, bad: np.ndarray, core: np.ndarray | None = None) -> np.ndarray:
    """1 for nodes of or above the main text: not below a marked node, with unmarked text below."""
    out = forest.above(bad[:, None])[:, 0]
    hidden = np.array([t in HIDDEN for t in forest.tags], bool)
    text = np.array([t == "#text" and bool(x.strip()) for t, x in zip(forest.tags, forest.texts)], bool)
    good = text & ~out if core is None else text & core & ~out
    return (forest.below(good) > 0) & ~out & ~hidden


def train(pages: list[str], variants: int = 2, seed: int = 42) -> boosting.Boosted:
    """Fit the node model on pages that name their article or main element. Where none of ``pages`` does, the
    lines of five words or more of all pages (of none: a stand-in line) take the place of main text, and only remakes train the model.

    Each page is used as it is, and in ``variants`` remakes: its blocks in containers of other
    names, among menus, side columns, notices, adverts, forms and comments filled with lines of
    other pages, so the model has to read attributes, densities and places, not one tag.
    """
    rng = random.Random(seed)
    known = [(p, x) for p in pages if (x := page_lines(p))]
    bare = not known
    if bare:
        known = [(p, [("p", x) for x in any_lines(p) if len(x.split()) > 4] or STAND_IN) for p in pages] or [("", STAND_IN)]
        known *= -(-50 // len(known))  # enough remakes to learn from
    pool = [line for _, x in known for _, line in x if len(line.split()) > 2] or ["a b c"]
    xs, ys = [], []
    for html, lines in known:
        plain = Forest([Dom(html)])
        core = plain.above(np.array([[t in ("article", "main")] for t in plain.tags], bool).reshape(-1, 1))[:, 0]
        marks = np.array([t in ("nav", "aside", "footer", "form") or bool(set(g) - {0}) for t, g in zip(plain.tags, plain.groups)], bool)
        made = [] if bare else [(plain, node_labels(plain, marks, core))]
        for _ in range(variants):
            dom = _Marked(variant(lines, pool, rng))
            forest = Forest([dom])
            bad = np.zeros(len(forest.tags), bool)
            bad[list(dom.bad)] = True
            made.append((forest, node_labels(forest, bad)))
        for forest, y in made:
            xs.append(forest.features())
            ys.append(y)
    return boosting.train(np.vstack(xs), np.concatenate(ys).astype(float))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 400, max_chars: int = 20_000, seed: int = 42) -> boosting.Boosted:
    """``train`` on at most ``max_pages`` pages of at most ``max_chars`` characters (the smallest
    hashes of id and html, repeated rows once): the bounded sample that reaches the driver. The
    hashes are chosen first, so no page but these travels. Every sampled page is used."""
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).cast("string").alias("html"))
    rows = rows.where(F.length("html").between(1, max_chars)).withColumn("h", F.xxhash64("id", "html"))
    last = rows.select("h").distinct().orderBy("h").limit(max_pages).agg(F.max("h")).first()[0]
    if last is None:
        return train([], seed=seed)
    sample = rows.where(F.col("h") <= last).groupBy("h").agg(F.first("html").alias("html"))
    return train([r.html for r in sorted(sample.collect())], seed=seed)


def extract_batch(pages: list[str | None], model: boosting.Boosted) -> list[str]:
    forest = Forest([Dom(p) for p in pages])
    if not forest.tags:
        return [""] * len(pages)
    gain = model.log_odds(forest.features())
    # inline content stands and falls with its block, and has no say in the choice of it
    gain = np.where(forest.inline(), np.maximum(gain, 1e-9 - BOND), gain)
    return forest.page_texts(forest.decode(gain))


def _extract(batches, model):
    for batch in slices(batches, "html", 1 << 19):
        texts = extract_batch(batch.column("html").to_pylist(), model)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, model: boosting.Boosted, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of each row: its main text and the text's code points.

    Character references are decoded; white space inside a block becomes one space; blocks are
    joined in page order by line feeds. Null and empty html, and pages of which no node is chosen,
    give an empty text. Null ids and urls are kept, repeated rows give a row each, unclosed and
    wrongly nested tags are closed as browsers do, an empty table gives no rows, and other
    columns are not read. Work grows linearly with a page's length and depth.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return map_rows(rows, partial(_extract, model=model), "page_id long, url string, text string, n_chars long")
