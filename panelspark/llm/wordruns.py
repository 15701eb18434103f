"""Periodic runs of words by suffix trees.

The tree of a document's words and the tree of their reversal are built by Ukkonen's algorithm. The Euler
tour of a tree lists its leaves with the depth of the branching between neighbours; the least depth
between two leaves is that of their lowest common ancestor, found in constant time from a sparse
table, and is the longest common extension of the two places. Every run has a Lyndon root, and that is the longest
Lyndon word at its place for the order of the words or the reverse order. These 2n candidates
are extended to the right in one tree and to the left in the other.

Before that, words that no run can hold are cut out: all eight-word sequences of a run of three periods and 24
words occur at least twice in it. Each stretch that is cut out becomes one symbol of its own.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import map_rows, slices

#: a run has at least this many words and this many periods
MIN_LENGTH, MIN_PERIODS = 24, 3
GRAM = 8


def suffix_tree(s: list[int], size: int) -> tuple[list[int], list[int], dict[int, int], list[int]]:
    """Ukkonen's tree of ``s`` (symbols below ``size``, the last one unique): edge starts and ends by node (0: the
    root; end -1: a leaf), children by node * size + first symbol, and the leaf of each suffix."""
    start, end, link, child, leaves = [0], [0], [0], {}, []
    node, edge, length, todo = 0, 0, 0, 0
    for i, c in enumerate(s):
        todo += 1
        waiting = 0
        while todo:
            if not length:
                edge = i
            key = node * size + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                leaves.append(len(start))
                start.append(i)
                end.append(-1)
                link.append(0)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                a, b = start[below], end[below]
                if b >= 0 and length >= b - a:
                    edge += b - a
                    length -= b - a
                    node = below
                    continue
                if s[a + length] == c:
                    if waiting:
                        link[waiting] = node
                    length += 1
                    break
                split = len(start)
                child[key] = split
                start += (a, i)
                end += (a + length, -1)
                link += (0, 0)
                leaves.append(split + 1)
                child[split * size + c] = split + 1
                start[below] = a + length
                child[split * size + s[a + length]] = below
                if waiting:
                    link[waiting] = split
                waiting = split
            todo -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - todo + 1
    return start, end, child, leaves


class SuffixOrder:
    """Leaves of the suffix tree of ``s`` in the order of its Euler tour, with the depths between them."""

    def __init__(self, s: list[int], size: int):
        start, end, child, leaves = suffix_tree(s, size)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        order = keys.argsort()
        self.keys, self.below = keys[order], below[order]
        self.size, self.n = size, len(s)
        self.first = np.searchsorted(self.keys, np.arange(len(start) + 1) * size).tolist()
        self.span = (np.array(end) - np.array(start)).tolist()
        suffix = np.full(len(start), -1)
        suffix[leaves] = np.arange(len(leaves))
        self.suffix = suffix.tolist()
        self.order, depths = self.tour(self.below.tolist())
        self.rank = np.empty(self.n, np.int64)
        self.rank[self.order] = np.arange(self.n)
        # sparse table: least depth over 2 ** k gaps between neighbouring leaves
        self.table = [np.array(depths[1:], dtype=np.int32)]
        step = 1
        while 2 * step <= self.n - 1:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def tour(self, below: list[int]) -> tuple[list[int], list[int]]:
        """Suffixes in the order in which the tour meets their leaves, and the depth of the deepest node
        above each leaf and the leaf before it."""
        first, span, suffix = self.first, self.span, self.suffix
        order, depths, turn = [], [], 0
        stack = [(0, 0, -1)]
        while stack:
            v, depth, above = stack.pop()
            if above >= 0:
                turn = above
            if suffix[v] >= 0:
                order.append(suffix[v])
                depths.append(turn)
                continue
            a, b = first[v], first[v + 1]
            for k in range(b - 1, a, -1):
                w = below[k]
                stack.append((w, depth + span[w], depth))
            stack.append((below[a], depth + span[below[a]], -1))
        return order, depths

    def rank_reversed(self) -> np.ndarray:
        """Ranks of the suffixes when symbols are ordered the other way, a prefix still before the longer."""
        node, symbol = self.keys // self.size, self.keys % self.size
        key = node * self.size + np.where(symbol == 0, 0, self.size - symbol)
        rank = np.empty(self.n, np.int64)
        rank[self.tour(self.below[key.argsort()].tolist())[0]] = np.arange(self.n)
        return rank

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j (i != j)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(b - a).astype(np.int64)
        level -= (1 << level) > b - a  # should a logarithm have been rounded up
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            t = self.table[k]
            out[at] = np.minimum(t[a[at]], t[b[at] - (1 << k)])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """First later place of smaller rank for each place (the length, if none)."""
    n = len(rank)
    out, stack = [n] * n, []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs(words: np.ndarray, least: int = MIN_LENGTH, periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, length, period) by start, then period: the maximal stretches of ``words`` (non-negative numbers) with
    smallest period q and at least max(least, periods * q) words (periods: 2 or more)."""
    n = len(words)
    if n < max(least, periods):
        return np.zeros((0, 3), np.int64)
    codes, s = np.unique(words, return_inverse=True)
    s = s + 1  # 0 ends the text
    size = len(codes) + 1
    tree = SuffixOrder(s.tolist() + [0], size)
    found = []
    for rank in (tree.rank, tree.rank_reversed()):
        i = np.arange(n)
        period = np.array(next_smaller(rank.tolist())[:n]) - i
        keep = (periods * period <= n) & (i + period < n)
        found.append(np.column_stack([i, period])[keep])
    i, p = np.unique(np.concatenate(found), axis=0).T
    if not len(i):
        return np.zeros((0, 3), np.int64)
    right = tree.extension(i, i + p)
    del tree
    back = SuffixOrder(s[::-1].tolist() + [0], size)
    left = np.zeros(len(i), np.int64)
    some = i > 0
    left[some] = back.extension(n - i[some], n - i[some] - p[some])
    out = np.column_stack([i - left, p + left + right, p])
    return np.unique(out[out[:, 1] >= np.maximum(least, periods * p)], axis=0)[:, [0, 1, 2]]


def possible(words: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Which words may lie in a run; texts laid end to end, ``ptr`` their offsets.

    A run of at least 3q and 24 words has more than 2q eight-word sequences, so each of them occurs twice,
    within one stretch of such sequences. Stretches are narrowed until nothing changes (hash
    collisions only keep words that could go).
    """
    n = len(words)
    part = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    if n < MIN_LENGTH:
        return np.zeros(n, bool)
    h = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    step = 1
    while step < GRAM:
        h = h[:-step] * np.uint64(0xFF51AFD7ED558CCD + 2 * step) ^ (h[step:] + (h[step:] >> np.uint64(29)))
        step *= 2
    at = np.flatnonzero(part[:n - GRAM + 1] == part[GRAM - 1:])
    group, h = part[at], h[at]
    while len(at):
        key = h ^ (group.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        order = key.argsort(kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # stretches of consecutive places of one group that are all kept
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1]) | ~twice[1:] | ~twice[:-1]])
        stretch = np.cumsum(new)
        twice &= np.bincount(stretch)[stretch] > MIN_LENGTH - GRAM
        if twice.all():
            break
        at, h, group = at[twice], h[twice], stretch[twice]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + GRAM, -1)
    return np.cumsum(edge[:n]) > 0


def runs_between(words: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """``runs`` of one text of which only the words marked in ``keep`` can lie in runs."""
    at = np.flatnonzero(keep)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    gap = np.concatenate([[False], np.diff(at) > 1])
    place = np.arange(len(at)) + np.cumsum(gap)
    short = np.empty(place[-1] + 1, np.int64)
    top = int(words.max()) + 1
    short[place[gap] - 1] = top + np.arange(int(gap.sum()))
    short[place] = words[at]
    back = np.zeros(len(short), np.int64)
    back[place] = at
    out = runs(short)
    out[:, 0] = back[out[:, 0]]
    return out


def _rewrite(ids: list) -> list[int]:
    return [-1 if i is None else zlib.crc32(str(i).encode()) for i in ids]


def _digest(batches, planted, outputs):
    for batch in slices(batches, "text"):
        rows, lists, flat = [], [], []
        ids = batch.column("id").to_pylist()
        for text, h in zip(batch.column("text").to_pylist(), _rewrite(ids) if planted else [-1] * len(ids)):
            words = (text or "").encode().split()
            n = len(words)
            if h >= 0 and h % 10 == 0 and n:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                unit = words[a:a + p]
                words[a:] = (unit * (-(-(n - a) // p)))[:n - a]
            lists.append(words)
            flat += words
        ptr = np.cumsum([0] + [len(w) for w in lists])
        codes = np.asarray(pa.array(flat, pa.large_binary()).dictionary_encode().indices).astype(np.int64)
        del flat
        keep = possible(codes, ptr)
        some = np.add.reduceat(np.append(keep, False).astype(np.int64), ptr[:-1]) * (np.diff(ptr) > 0) if len(lists) else []
        for words, a, b, any_kept in zip(lists, ptr.tolist(), ptr[1:].tolist(), some):
            found = runs_between(codes[a:b], keep[a:b]).tolist() if any_kept else []
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in found:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
            rows.append((len(found), *best, 1000 * best[1] // best[2] if found else None,
                         hashlib.sha256("".join(f"{x},{y},{z}\n" for x, y, z in found).encode()).hexdigest(),
                         hashlib.sha256(b" ".join(words)).hexdigest(), found if outputs else None, b" ".join(words).decode() if outputs else None))
        n_runs, start, length, period, milli, runs_sha, text_sha, spans, kept = map(list, zip(*rows))
        long = pa.int64()
        span = pa.struct([("start", long), ("length", long), ("period", long)])
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array(n_runs, long), pa.array(start, long), pa.array(length, long), pa.array(period, long),
            pa.array(milli, long), pa.array(runs_sha), pa.array(text_sha),
            pa.array([x if x is None else [dict(zip(("start", "length", "period"), r)) for r in x] for x in spans], pa.list_(span)),
            pa.array(kept, pa.string())],
            names=["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"])


SCHEMA = ("id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
          "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False, outputs: bool = True) -> DataFrame:
    """Periodic runs of each row's words, and its text without the repeats.

    Words are parted by ASCII white space and compared exactly. A run is a maximal stretch of words with smallest period
    q and at least max(24, 3q) words; a word that any run holds after its first q words is dropped from ``collapsed``.
    ``start, length, period, exponent_milli`` are those of the run of greatest length / period (ties: smallest start,
    then period; no run: null), ``runs`` lists all by start, then period. With ``planted``, one row in ten (by the CRC-32 of
    its id) is first made periodic from some word on, as the registered query asks; a null id never is.

    Without ``outputs``, ``runs`` and ``collapsed`` are null and only their digests are given.

    A null, empty or blank text has no runs. Null and repeated ids, repeated rows and other columns make no
    difference; an empty table gives no rows. A task holds a slice of about 4 MB of text (one whole text,
    where that is longer) and the trees of one text at a time.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, partial(_digest, planted=planted, outputs=outputs), SCHEMA)
