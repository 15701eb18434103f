"""Language identification by mixture inference over n-gram likelihoods."""

from __future__ import annotations

import unicodedata
import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Chunks, WordCache, expand, map_rows, slices, text_bytes, text_of_row
from panelspark.llm.tokens import row_sums

BITS = 16
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD], np.uint64)  # odd multipliers of a linear hash
_KIND = np.full(0x110000, 255, np.uint8)
_GRAMS = WordCache("langid")
_SCORES: dict = {}


@dataclass
class LanguageModel:
    """``logp[b, l]``: log-likelihood of n-gram bucket b in language ``langs[l]``."""

    langs: list[str]
    logp: np.ndarray
    name: int


def _kinds(points: np.ndarray) -> np.ndarray:
    """1 for letters, 2 for combining marks, 0 for other code points; looked up once per worker."""
    new = np.unique(points[_KIND[points] == 255])
    _KIND[new] = [{"L": 1, "M": 2}.get(unicodedata.category(chr(c))[0], 0) for c in new.tolist()]
    return _KIND[points]


def _grams(words: list[bytes]) -> list[bytes]:
    """Buckets of the character trigrams of each word's runs of letters (with the marks after them).

    A run has one trigram round each of its characters; beyond its ends stand spaces.
    """
    texts = [w.decode("utf-8", "replace").lower() for w in words]
    points = np.frombuffer("".join([t + "\n" for t in texts]).encode("utf-32-le"), "<u4")
    kind = _kinds(points)
    base = np.maximum.accumulate(np.where(kind != 2, np.arange(len(points)), 0))  # the last character that is no mark
    inside = kind[base] == 1
    at = np.flatnonzero(inside)  # never the last one, a line feed
    before = np.where(inside[at - 1] & (at > 0), points[at - 1], 32)
    after = np.where(inside[at + 1], points[at + 1], 32)
    mixed = sum(c.astype(np.uint64) * m for c, m in zip((before, points[at], after), _MIX))
    raw = (mixed >> np.uint64(64 - BITS)).astype("<u4").tobytes()
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    ends = (4 * np.searchsorted(at, ends)).tolist()
    return [raw[i:j] for i, j in zip([0, *ends], ends)]


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in slices(batches, "text"):
        chunks = Chunks(*text_bytes(batch.column("text")), marks=True)
        coded = _GRAMS.fill([w.strip().lower() for w in chunks.words], _grams)
        lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        flat = np.frombuffer(b"".join(coded), "<u4")
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        n = np.diff(chunks.ptr)
        for lang in set(langs.tolist()):
            times = np.bincount(chunks.codes[np.repeat(langs == lang, n)], minlength=len(chunks.words))
            counts = np.bincount(flat, weights=np.repeat(times, lens), minlength=1 << BITS)
            totals[lang] = totals.get(lang, 0) + counts
    for lang, counts in totals.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(counts[some])], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", use: Column | None = None, smooth: float = 0.5) -> LanguageModel:
    """Character trigram models of each language from all rows with a language that ``use`` allows.

    Counted per partition and language, then added up; the sums (2^16 buckets per language)
    reach the driver. A table without such rows gives a model without languages.
    """
    rows = docs if use is None else docs.where(use)
    rows = rows.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = map_rows(rows, _count, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums.lang.unique())
    counts = np.zeros((1 << BITS, len(langs)))
    counts[sums.bucket.to_numpy(int), np.searchsorted(langs, sums.lang) if len(langs) else []] = sums.n
    logp = np.log(counts + smooth) - np.log(counts.sum(axis=0) + smooth * len(counts))
    logp = logp.astype(np.float32)
    return LanguageModel(list(langs), logp, zlib.crc32(logp.tobytes()))


def _relative(ll: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likelihoods (languages x words) relative to each word's best language, and that one's logarithm.
    None is zero, so that a word of any length leaves every mixture a finite likelihood."""
    top = ll.max(axis=1)
    return np.exp(np.maximum(np.ascontiguousarray((ll - top[:, None]).T), -600.0)), top


def _step(p: np.ndarray, n: np.ndarray, at: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round of expectation-maximisation on rows of ``n`` words from ``at`` on: the sums of each
    language's likelihood over the mixture's (languages x rows), and the words' mixture likelihoods."""
    mix = np.einsum("lw,lw->w", np.repeat(share, n, axis=1), p)
    return np.add.reduceat(p / mix, at, axis=1), mix


def _fit(p: np.ndarray, n: np.ndarray, at: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    for _ in range(rounds):
        share = share * _step(p, n, at, share)[0] / n
        share[share < 1e-6] = 0
        share /= share.sum(axis=0)
    return share, np.add.reduceat(np.log(np.einsum("lw,lw->w", np.repeat(share, n, axis=1), p)), at)


def mixture(ll: np.ndarray, ptr: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for each row's language proportions from ``start`` (rows x
    languages; zeros stay zero): (proportions, log-likelihoods). No row is empty."""
    p, top = _relative(ll)
    share, like = _fit(p, np.diff(ptr), ptr[:-1], start.T, rounds)
    return share.T, like + np.add.reduceat(top, ptr[:-1])


def _of_rows(p: np.ndarray, n: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, word counts and offsets of some of the rows."""
    n = n[rows]
    new = np.cumsum(n) - n
    return p[:, np.repeat(at[rows] - new, n) + np.arange(n.sum())], n, new


def infer(ll: np.ndarray, ptr: np.ndarray, rounds: int = 12, checks: int = 4, block: int = 1 << 16) -> np.ndarray:
    """Proportions of each row's language set, chosen by penalised likelihood.

    ``ll`` holds the log-likelihood of each word (rows end to end, no empty row) in each language.
    A set of s languages is scored by its fitted likelihood less (s - 1) log(words + 1). Rows of
    which no mixture can beat the best single language are settled without fitting. The
    log-likelihood is concave in the proportions, so no mixture is above its tangent at any
    mixture m: the likelihood of m, plus the largest sum over the words of a language's
    likelihood over m's, less the number of words. ``checks`` rounds of expectation-maximisation
    from near the best language move m and lower this bound. The others are fitted with all
    languages, then with their 2, 3, ... largest, until the same bound, at the fit with all, shows
    that no larger set can beat the best one so far. Rows are worked through in runs of about
    ``block`` words; none is cut.
    """
    group = (ptr[:-1] - ptr[0]) // block
    edges = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(group)]
    return np.concatenate([np.zeros((0, ll.shape[1])), *(
        _infer(ll[ptr[a]:ptr[b]].astype(np.float64), ptr[a:b + 1] - ptr[a], rounds, checks) for a, b in zip(edges, edges[1:]))])


def _infer(ll, ptr, rounds, checks):
    n, at, langs = np.diff(ptr), ptr[:-1], ll.shape[1]
    alone = np.add.reduceat(ll, at, axis=0)
    best = alone.argmax(axis=1)
    share = np.zeros_like(alone)
    share[np.arange(len(n)), best] = 1
    p, top = _relative(ll)
    score = alone.max(axis=1) - np.add.reduceat(top, at)  # relative to each word's best language, like all below
    penalty = np.log(n + 1)
    open_ = np.flatnonzero(-score > penalty)
    if not len(open_) or langs < 2:
        return share
    p, n, at = _of_rows(p, n, at, open_)
    near = np.where(np.arange(langs)[:, None] == best[open_], 0.97, 0.03 / (langs - 1))
    for _ in range(checks):
        ratio, mix = _step(p, n, at, near)
        bound = np.add.reduceat(np.log(mix), at) + ratio.max(axis=0) - n
        left = np.flatnonzero(bound - penalty[open_] > score[open_])
        near = (near * ratio / n)[:, left]
        p, n, at = _of_rows(p, n, at, left)
        open_ = open_[left]
        if not len(open_):
            return share
    full, _ = _fit(p, n, at, np.full((langs, len(open_)), 1 / langs), rounds)
    ratio, mix = _step(p, n, at, full)
    bound = np.add.reduceat(np.log(mix), at) + ratio.max(axis=0) - n
    rank = (-full).argsort(axis=0, kind="stable").argsort(axis=0, kind="stable")
    for s in range(2, langs + 1):
        left = np.flatnonzero(bound - (s - 1) * penalty[open_] > score[open_])
        if not len(left):
            break
        if len(left) < len(open_):
            p, n, at = _of_rows(p, n, at, left)
            open_, full, rank, bound = open_[left], full[:, left], rank[:, left], bound[left]
        start = np.where(rank < s, np.maximum(full, 1e-3), 0)
        fit_, like = _fit(p, n, at, start / start.sum(axis=0), rounds)
        value = like - (s - 1) * penalty[open_]
        won = value > score[open_]
        share[open_[won]], score[open_[won]] = fit_.T[won], value[won]
    return share


def _predict(batches, model, rounds, row_text=None):
    if model.name not in _SCORES:
        _SCORES.clear()
        _SCORES[model.name] = WordCache("langid")
    cache, width = _SCORES[model.name], len(model.langs)

    def scores(words):
        coded = _GRAMS.fill(words, _grams)
        lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        sums = row_sums(model.logp[np.frombuffer(b"".join(coded), "<u4")], np.concatenate([[0], np.cumsum(lens)]))
        return [s.tobytes() if k else b"" for s, k in zip(sums.astype("<f4"), lens)]

    names = np.array([*model.langs, "und"], dtype=object)
    for batch in slices(text_of_row(batches, row_text) if row_text else batches, "text"):
        rows = batch.num_rows
        share = np.zeros((rows, width))
        if width:
            chunks = Chunks(*text_bytes(batch.column("text")), marks=True)
            coded = cache.fill([w.strip().lower() for w in chunks.words], scores)
            has = np.array([len(c) > 0 for c in coded], dtype=np.int64)
            table = np.frombuffer(b"".join(coded), "<f4").reshape(-1, width)
            ll, at = expand(table, has, chunks.codes)
            ptr = at[chunks.ptr]
            some = np.flatnonzero(np.diff(ptr))
            if len(some):
                share[some] = infer(ll, np.append(ptr[:-1][some], ptr[-1]), rounds)
        known = share.sum(axis=1) > 0
        top = np.where(known, share.argmax(axis=1) if width else 0, width)
        sets = [[[model.langs[l], float(v[l])] for l in np.argsort(-v, kind="stable") if v[l] > 0] for v in share]
        keep = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in keep), pa.array(names[top], pa.string()),
            pa.array(share.max(axis=1) if width else np.zeros(rows)),
            pa.array([[x[0] for x in s] for s in sets], pa.list_(pa.string())), pa.array([[x[1] for x in s] for s in sets], pa.list_(pa.float64()))],
            names=[*keep, "lang_pred", "score", "languages", "shares"])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", rounds: int = 12) -> DataFrame:
    """``id, lang_pred, score, languages, shares`` per row.

    ``languages`` is the chosen set with the share of words of each, ``lang_pred`` its largest and
    ``score`` that share (ties: the first in alphabetical order). A null text, one without a letter,
    and every text under a model without languages give ``und``, score 0 and an empty set. Null
    and repeated ids and repeated rows are predicted like others; an empty table gives no rows.
    """
    return _identified(docs, model, id_col, text_col, rounds).withColumnRenamed("kept", "id")


def _identified(docs, model, id_col, text_col, rounds, whole=False) -> DataFrame:
    """``kept`` is the id or, with ``whole``, a struct of all columns."""
    if whole:
        rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("kept"))
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("kept"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, partial(_predict, model=model, rounds=rounds, row_text=text_col if whole else None),
                    f"kept {rows.schema['kept'].dataType.simpleString()}, lang_pred string, score double, languages array<string>, shares array<double>")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least_share: float = 0.5, rounds: int = 12) -> DataFrame:
    """The rows, with all their columns, that have a language with at least ``least_share`` of
    their words; ``und`` rows and mixtures without such a language go."""
    found = _identified(docs, model, None, text_col, rounds, whole=True)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= F.lit(least_share))).select("kept.*")
