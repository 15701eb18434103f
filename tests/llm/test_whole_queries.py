"""op2, op7 and op9 as wholes, on all rows of a table and on edge rows, against plain Python from the definitions."""

import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import regex
import xxhash

from edge_rows import SF_SMALL, edge_docs  # noqa: F401
from panelspark.llm import quality, queries, toxicity
from panelspark.llm.common import table

SF = "/root/testdata/sf0.01"  # the small one holds too few toxic rows for a model
GOLDEN, PAIR, WRAP = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 1 << 64  # fixed values of the hashed buckets


def hashes(text):
    return [zlib.crc32(t.encode()) for t in re.findall(r"\w+|[^\w\s]+", (text or "").lower())]


def bucket(h, bits):
    return h * GOLDEN % WRAP >> 64 - bits


def grams(text):
    h = hashes(text)
    return [bucket(x, 16) for x in h] + [bucket((a * PAIR + b + 1) % WRAP, 16) for a, b in zip(h, h[1:])]


def learnable(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 != 0


def noise(doc_id, text, seed=42):
    """The engine's xxhash64 of (id, text, seed): each value hashed with the last hash as seed, nulls left out."""
    h = 42
    for part in (None if doc_id is None else struct.pack("<q", doc_id), None if text is None else text.encode(), struct.pack("<i", seed)):
        h = h if part is None else xxhash.xxh64_intdigest(part, seed=h)
    return ((h >> 11) + 0.5) * 2.0 ** -53


def plain_resample(docs, target, prior):
    """{(id, text): (tokens, log ratio, key, selected)} for target model texts ``target``."""
    raw = Counter(g for _, text in docs for g in grams(text))
    goal = Counter(g for text in target for g in grams(text))
    scale = sum(goal.values()) / max(sum(raw.values()), 1)
    rows = []
    for doc_id, text in docs:
        ratio = sum(float(np.float32(math.log(goal[g] + 500) - math.log(raw[g] * scale + 500))) for g in grams(text))
        rows.append((doc_id, text, len(hashes(text)), ratio, ratio - math.log(-math.log(noise(doc_id, text)))))
    able = sorted((r[4] for r in rows if r[2]), reverse=True)
    k = sum(r[2] > 0 and r[3] + math.log(prior / (1 - prior)) >= 0 for r in rows)
    return {(r[0], r[1]): (*r[2:], r[2] > 0 and k > 0 and r[4] >= able[k - 1] - 2.0 ** -31) for r in rows}


def check_resample(rows, want, texts):
    assert len(rows) == len(texts)
    for r in rows:
        doc_id = r[0]
        options = [want[k] for k in want if k[0] == doc_id]
        assert any(r.n_tokens == n and abs(r.log_ratio - ratio) < 1e-6 and abs(r.key - key) < 1e-6 and r.selected == chosen
                   for n, ratio, key, chosen in options), r


def test_quality_query_equals_plain_resampling(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    marks = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect() if r.quality is not None and learnable(r.doc_id)}
    prior = sum(marks.values()) / len(marks)
    want = plain_resample(docs, [t for i, t in docs if marks.get(i) == 1], prior)
    got = queries.op2_quality_resampling(spark, SF_SMALL).collect()
    check_resample(got, want, docs)
    assert 0 < sum(r.selected for r in got) < len(got)
    edge = [(r.doc_id, r.text) for r in edge_docs.collect()]
    labels = spark.createDataFrame([(i, 1) for i in {i for i, t in edge if i is not None and t}], "doc_id long, quality int")
    model = quality.fit(edge_docs, labels)
    check_resample(quality.resample(edge_docs, model).collect(),
                   plain_resample(edge, [t for i, t in edge if i is not None and any(j == i and s for j, s in edge)], model.prior), edge)


def test_toxicity_query_equals_plain_scoring(spark):
    docs = {r.doc_id: {bucket(h, toxicity.BITS) for h in hashes(r.text)} for r in table(spark, SF, "documents").collect()}
    marks = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect() if r.toxic is not None and learnable(r.doc_id)}
    prior = min(max(sum(marks.values()) / len(marks), 1e-3), 0.9)
    pos, unl = [docs[i] for i in docs if marks.get(i) == 1], [docs[i] for i in docs if learnable(i)]
    in_pos, in_unl = Counter(b for d in pos for b in d), Counter(b for d in unl for b in d)
    kept = []
    for b, n in in_pos.items():
        p, u = (n + 0.5) / (len(pos) + 1), (in_unl[b] + 0.5) / (len(unl) + 1)
        if n >= 5 and (p - u) / math.sqrt(u * (1 - u) * (1 / len(pos) + 1 / len(unl))) >= 5:
            kept.append(b)
    kept.sort()
    assert kept  # toxic words enough to learn from
    dense = [np.array([[float(b in d) for b in kept] for d in part]).reshape(len(part), len(kept)) for part in (pos, unl)]
    w, bias = toxicity.train_nnpu(*dense, prior)
    got = queries.op7_toxicity(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        f = bias + sum(x for b, x in zip(kept, w) if b in docs[r.doc_id])
        assert abs(r.score - 1 / (1 + math.exp(-f))) < 1e-6, r
        assert r.held_out == (not learnable(r.doc_id)) and r.predicted == (r.score >= 0.5)


MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)  # fixed values of the trigram buckets


def trigram_words(text):
    """Trigram buckets of each word that has a letter."""
    words = []
    for word in re.split(r"[\t-\r ]+|(?<=[A-Za-z])(?=[!-@\[-`{-~])", text or ""):
        out = []
        for run in regex.findall(r"\p{L}[\p{L}\p{M}]*", word.lower()):
            padded = f" {run} "
            out += [sum(ord(c) * m for c, m in zip(padded[i:i + 3], MIX)) % WRAP >> 48 for i in range(len(run))]
        if out:
            words.append(out)
    return words


def plain_shares(ll, rounds=12):
    """The language set of best penalised likelihood: every size is fitted."""
    def fit(pi):
        for _ in range(rounds):
            r = like * pi
            pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
            pi[pi < 1e-6] = 0
            pi = pi / pi.sum()
        return pi, np.log((like * pi).sum(axis=1)).sum()

    like = np.exp(np.maximum(ll - ll.max(axis=1, keepdims=True), -600))
    n, langs = ll.shape
    alone = np.log(like).sum(axis=0)
    best, score = np.eye(langs)[ll.sum(axis=0).argmax()], alone.max()
    full, _ = fit(np.full(langs, 1 / langs))
    order = np.argsort(-full, kind="stable")
    for s in range(2, langs + 1):
        start = np.zeros(langs)
        start[order[:s]] = np.maximum(full[order[:s]], 1e-3)
        share, value = fit(start / start.sum())
        if value - (s - 1) * math.log(n + 1) > score:
            best, score = share, value - (s - 1) * math.log(n + 1)
    return best


def test_language_query_equals_plain_inference(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    words = {r.doc_id: trigram_words(r.text) for r in docs}
    langs = sorted({r.lang for r in docs if r.lang is not None})
    counts = np.zeros((1 << 16, len(langs)))
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            np.add.at(counts[:, langs.index(r.lang)], [b for w in words[r.doc_id] for b in w], 1)
    logp = (np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 0.5 * len(counts))).astype(np.float32)
    got = queries.op9_language_id(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        if not words[r.doc_id]:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        want = plain_shares(np.array([logp[w].astype(float).sum(axis=0) for w in words[r.doc_id]]))
        shares = dict(zip(r.languages, r.shares))
        assert np.allclose([shares.get(x, 0.0) for x in langs], want, atol=1e-3), (r.doc_id, shares, want)
        assert abs(r.score - want.max()) < 1e-3 and want[langs.index(r.lang_pred)] > want.max() - 1e-3
