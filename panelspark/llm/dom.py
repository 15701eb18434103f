"""Pages as flat node arrays in page order, and features of their nodes."""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template title svg iframe".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody
td textarea tfoot th thead tr ul""".split())
#: an element of the first kind ends an open element of the second, looked for up to the third
IMPLIED = {t: ({"p"}, {"body", "html", "td", "th", "caption", "button", "object"} | (BLOCK - {"p"})) for t in BLOCK - {"body", "html", "option", "tr", "td", "th", "tbody"}}
IMPLIED |= {"li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
            "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
            "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"})}

TAGS = {
    "text": ["#text"], "page": ["html", "body"], "para": ["p"], "head": ["h1", "h2", "h3", "h4", "h5", "h6", "hgroup"],
    "list": ["ul", "ol", "dl", "menu", "dir"], "item": ["li", "dd", "dt"], "link": ["a"], "box": ["div", "section", "center"],
    "main": ["article", "main"], "nav": ["nav"], "foot": ["footer"], "top": ["header"], "aside": ["aside", "dialog", "details"],
    "form": ["form", "input", "button", "select", "option", "textarea", "label", "fieldset", "legend"],
    "table": ["table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"], "quote": ["blockquote", "pre", "code", "figure", "figcaption"],
}
TAG_GROUP = {t: i for i, ts in enumerate(TAGS.values()) for t in ts}
FORM = TAG_GROUP["form"]
BOND = 1.0  # what a node gains by following its chosen parent
#: words in class, id and role attributes (an added s counts as the same word)
ATTRS = {
    "good": "article content post entry story main body text prose page-content markdown read hentry".split(),
    "menu": "nav navbar navigation menu submenu breadcrumb toc tab pagination pager skip toolbar".split(),
    "edge": "foot footer copyright colophon legal bottom".split(),
    "top": "header head masthead banner logo brand topbar".split(),
    "side": "side sidebar aside rail widget related recommend more promo teaser also popular trending".split(),
    "ads": "ad advert advertisement advertising sponsor sponsored dfp promo outbrain taboola".split(),
    "notice": "cookie consent gdpr notice alert popup modal overlay newsletter subscribe paywall toast privacy".split(),
    "talk": "comment reply replies disqus discussion respond thread feedback".split(),
    "share": "share sharing social follow tag meta byline author rating like".split(),
    "form": "form search login signup signin register input".split(),
}
WORD = re.compile(r"[a-z]+|[0-9]+")


@lru_cache(4096)
def word_groups(value: str) -> frozenset[int]:
    words = WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return frozenset(i for i, known in enumerate(ATTRS.values())
                     if any(w in known or (w.endswith("s") and w[:-1] in known) for w in words))


def attribute_groups(attrs) -> list[int]:
    """Numbers of the groups that the words of class, id and role belong to."""
    out = set()
    for name, value in attrs:
        if value and name in ("class", "id", "role", "aria-label", "itemprop"):
            out |= word_groups(value)
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            out.add(list(ATTRS).index("notice"))
    return sorted(out)


class Dom(HTMLParser):
    """Nodes of one page in page order: parent, subtree end, depth, tag, attribute groups, text, block."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.parent, self.end, self.depth, self.tag, self.groups, self.text, self.block = [], [], [], [], [], [], []
        self.stack: list[int] = []
        self.hidden = 0  # depth of the stack at which hidden content began
        self.blocks = 0
        if html:
            self.feed(html.replace("\0", ""))
            self.close()
        while self.stack:
            self._pop()

    def _add(self, tag, groups, text):
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.depth.append(len(self.stack))
        self.end.append(len(self.tag) + 1)
        self.tag.append(tag)
        self.groups.append(groups)
        self.text.append(text)
        self.block.append(self.blocks)

    def _pop(self):
        i = self.stack.pop()
        self.end[i] = len(self.tag)
        if self.tag[i] in BLOCK:
            self.blocks += 1
        if len(self.stack) < self.hidden:
            self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.hidden and self.tag[self.stack[self.hidden - 1]] == "head":
            while self.hidden:  # a head that was left open
                self._pop()
        if tag in IMPLIED and not self.hidden:
            ends, stop = IMPLIED[tag]
            for k in range(len(self.stack) - 1, -1, -1):
                t = self.tag[self.stack[k]]
                if t in ends:
                    while len(self.stack) > k:
                        self._pop()
                    if tag not in ("li", "dt", "dd", "tr", "td", "th", "tbody"):
                        break
                elif t in stop:
                    break
        if tag in BLOCK:
            self.blocks += 1
        if tag == "br" and not self.hidden:
            self._add("#text", [], " ")
        if tag in VOID:
            return
        self._add(tag, attribute_groups(attrs), "")
        self.stack.append(len(self.tag) - 1)
        if tag in HIDDEN and not self.hidden:
            self.hidden = len(self.stack)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in HIDDEN:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.tag[self.stack[k]] == tag:
                while len(self.stack) > k:
                    self._pop()
                return
            if tag in ("p", "b", "i", "a", "span", "em", "strong", "li") and self.tag[self.stack[k]] in ("article", "body", "div", "td", "section"):
                return  # does not reach out of its container

    def handle_data(self, data):
        if not self.hidden and data:
            self._add("#text", [], data)


class Forest:
    """Several pages' nodes end to end, with sums over subtrees."""

    def __init__(self, pages: list[Dom]):
        sizes = np.array([len(p.tag) for p in pages], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        base = self.first[:-1][self.page]
        flat = lambda name, kind=np.int64: np.array([v for p in pages for v in getattr(p, name)], dtype=kind)
        parent = flat("parent")
        self.root = parent < 0
        self.parent = np.where(self.root, np.arange(len(parent)), parent + base)
        self.end = flat("end") + base
        self.depth = flat("depth")
        self.tags = [t for p in pages for t in p.tag]
        self.groups = [g for p in pages for g in p.groups]
        self.texts = [t for p in pages for t in p.text]
        self.block = flat("block")

    def below(self, x: np.ndarray) -> np.ndarray:
        """Sum of ``x`` over each node's subtree, itself included."""
        total = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
        return total[self.end] - total[:-1]

    def above(self, flags: np.ndarray) -> np.ndarray:
        """Whether a node or one of its ancestors has the flag (columns apart)."""
        # a subtree is a range of nodes in page order: count the ranges of flagged nodes that cover each node
        edge = np.zeros((len(flags) + 1, flags.shape[1]), np.int64)
        edge[:-1] += flags
        np.add.at(edge, self.end, -flags.astype(np.int64))
        return np.cumsum(edge[:-1], axis=0) > 0

    def levels(self) -> list[np.ndarray]:
        """Nodes by depth, the roots first."""
        order = self.depth.argsort(kind="stable")
        return np.split(order, np.searchsorted(self.depth[order], np.arange(1, int(self.depth.max(initial=0)) + 1)))

    def features(self) -> np.ndarray:
        """Per node: tag group, attribute groups (own, above, share below), subtree text and link
        density, paragraphs, signs, depth, place among siblings and on the page, and the same
        densities of the parent and the neighbouring siblings."""
        n = len(self.tags)
        tag = np.array([TAG_GROUP.get(t, len(TAGS)) for t in self.tags], dtype=np.int64)
        own = np.zeros((n, len(ATTRS)), bool)
        for i, g in enumerate(self.groups):
            if g:
                own[i, g] = True
        one = np.zeros((n, len(TAGS) + 1))
        one[np.arange(n), tag] = 1
        words = np.array([len(t.split()) for t in self.texts], dtype=np.float64)
        signs = np.array([t.count(".") + t.count(",") + t.count("?") + t.count("!") for t in self.texts], dtype=np.float64)
        kinds = list(TAGS)
        link = self.above((tag == kinds.index("link"))[:, None])[:, 0]
        text, linked, marks = self.below(words), self.below(words * link), self.below(signs)
        nodes = self.end - np.arange(n)
        paras = self.below(one[:, kinds.index("para")])
        total = np.maximum(np.bincount(self.page, words, len(self.first) - 1), 1)[self.page]
        before = np.concatenate([[0.0], np.cumsum(words)])[:-1]
        before = before - before[self.first[:-1][self.page]] if n else before
        # place among siblings: order nodes by parent, then page order
        kin = np.where(self.root, -1 - self.page, self.parent)
        order = np.argsort(kin, kind="stable")
        start = np.flatnonzero(np.diff(kin[order], prepend=np.iinfo(np.int64).min))
        count = np.diff(np.append(start, n))
        place, many = np.zeros(n), np.zeros(n)
        place[order] = np.arange(n) - np.repeat(start, count)
        many[order] = np.repeat(count, count)
        prev, after = np.zeros(n), np.zeros(n)
        same = kin[order][1:] == kin[order][:-1] if n else np.zeros(0, bool)
        prev[order[1:][same]] = text[order[:-1][same]]
        after[order[:-1][same]] = text[order[1:][same]]
        dens, share = text / nodes, linked / np.maximum(text, 1)
        up = self.parent
        upper = self.above(own) & ~own
        tag_above = self.above(one[:, [kinds.index(k) for k in ("main", "nav", "foot", "top", "aside", "form", "list")]] > 0)
        shares = np.column_stack([self.below(own[:, j]) for j in range(own.shape[1])]) / nodes[:, None]
        return np.column_stack([
            one, own, upper, shares, tag_above, np.log1p(text), dens, share, np.log1p(paras), marks / np.maximum(text, 1), text / total,
            before / total, self.depth, place, many, place / np.maximum(many, 1), np.log1p(prev), np.log1p(after), np.log1p(text[up]),
            dens[up], share[up], np.log1p(paras[up]), many[up]]).astype(np.float32)

    def inline(self) -> np.ndarray:
        """Text and plain inline elements of blocks without blocks in them: what a reader sees as part of that block.
        Form controls, and elements that class or id name as something else than content, are left out."""
        block = np.array([t in BLOCK for t in self.tags], bool)
        own = np.arange(len(self.tags))
        for at in self.levels()[1:]:
            own[at] = np.where(block[at], at, own[self.parent[at]])
        other = np.array([TAG_GROUP.get(t) == FORM or bool(set(g) - {0}) for t, g in zip(self.tags, self.groups)], bool)
        return ~block & ~other & (self.below(block) == 0) & block[own] & (self.below(block)[own] == 1)

    def decode(self, gain: np.ndarray, bond: float = BOND) -> np.ndarray:
        """The best consistent choice of nodes: a node can be chosen only below a chosen one.

        ``gain`` is a node's log-odds, ``bond`` what a node gains by following its chosen parent. From the leaves up, a subtree is worth its node's gain and
        the worth of its children where positive; from the root down, subtrees of positive worth
        below chosen nodes are chosen.
        """
        worth = gain.astype(np.float64) + np.where(self.root, 0.0, bond)
        levels = self.levels()
        for at in levels[:0:-1]:
            np.add.at(worth, self.parent[at], np.maximum(worth[at], 0))
        chosen = (worth > 0) & self.root
        for at in levels[1:]:
            chosen[at] = (worth[at] > 0) & chosen[self.parent[at]]
        return chosen

    def page_texts(self, chosen: np.ndarray) -> list[str]:
        """Each page's chosen text: white space in a block is one space, blocks are lines."""
        out: list[str] = []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            lines: list[list[str]] = []
            last = None
            for i in range(a, b):
                if self.tags[i] == "#text" and chosen[i]:
                    if self.block[i] != last:
                        lines.append([])
                        last = self.block[i]
                    lines[-1].append(self.texts[i])
            blocks = (" ".join("".join(x).split()) for x in lines)
            out.append("\n".join(x for x in blocks if x))
        return out
