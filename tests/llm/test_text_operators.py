"""Tokenising, packing, SimHash, quality, language and toxicity against brute force, libraries and labels."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
import tokenizers
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from edge_rows import SF_SMALL, edge_docs, edge_labels, no_docs  # noqa: F401
from panelspark.llm import bpe, langid, packing, quality, queries, simhash, toxicity
from panelspark.llm.common import fold, table

MULTI, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocab():
    own = bpe.vocabulary(MULTI, P.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abthe ing \n\t \u0085\x1c　é1!'.,sİΣ日"), max_size=120))
def test_bpe_equals_library(vocab, text):
    import pyarrow as pa

    own, lib = vocab
    ids, ptr = own.encode_column(pa.array([text, None, text]))
    assert ids[:ptr[1]].tolist() == lib.encode_ordinary(text) == ids[ptr[2]:].tolist()
    assert own.decode(ids[:ptr[1]]) == text.encode()


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="aetinos", min_size=30, max_size=1500))
def test_bpe_tree_joins_long_pieces(vocab, text):
    own, lib = vocab
    assert own.piece(text.encode()) == lib.encode_ordinary(text)


def test_bpe_round_trip_rows(spark, edge_docs, no_docs, vocab):
    got = {r.doc_id: r for r in bpe.round_trip(edge_docs, MULTI, P.PATTERN).collect()}
    for r in edge_docs.collect():
        ids = vocab[1].encode_ordinary(r.text or "")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.round_trip(no_docs, MULTI, P.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(edge_docs, MULTI, P.PATTERN), MULTI, P.PATTERN).collect()
    assert {r.id: bytes(r.data).decode() for r in back} == {r.doc_id: r.text or "" for r in edge_docs.collect()}


def check_packing(docs, pieces, window):
    lib = tokenizers.Tokenizer.from_file(WORDS)
    lib.encode_special_tokens = True
    seqs, per_doc = {}, {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
        per_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for k, parts in seqs.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and (at == window or k == max(seqs))
    want = {}
    for r in docs:
        ids = np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault((r.doc_id, len(ids)), []).append(ids)
    assert set(want) == set(per_doc)
    for key, copies in want.items():
        assert sum(p.length for p in per_doc[key]) == sum(map(len, copies))
        crcs = {(p.start, p.length, p.ids_crc32) for p in per_doc[key]}
        assert crcs <= {(p.start, p.length, zlib.crc32(c[p.start:p.start + p.length].tobytes())) for p in per_doc[key] for c in copies}


def test_packing(spark, edge_docs, no_docs):
    for window in (64, 4096):
        check_packing(edge_docs.collect(), packing.pack(edge_docs.repartition(3), WORDS, window=window).collect(), window)
    assert packing.pack(no_docs, WORDS).count() == 0
    check_packing(table(spark, SF_SMALL, "documents").collect(), queries.op10_packing(spark, SF_SMALL).collect(), 4096)


def brute_fingerprint(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)] * bool(words)
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, budget=3):
    low = {f: min([i for i, g in zip(ids, fps) if g == f and i is not None], default=None) for f in fps}
    label = {f: f for f in low}
    keys = sorted(label)
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (a ^ b).bit_count() <= budget and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    best = {}
    for f, r in label.items():
        if low[f] is not None:
            best[r] = min(best.get(r, low[f]), low[f])
    return [best.get(label[f]) for f in fps]


def test_simhash_equals_brute_force(spark, edge_docs, no_docs):
    for docs in (edge_docs, table(spark, SF_SMALL, "documents")):
        rows = docs.collect()
        fps = [brute_fingerprint(r.text) for r in rows]
        comps = brute_components([r.doc_id for r in rows], fps)
        want = sorted((str(r.doc_id), f"{f:016x}", str(c)) for r, f, c in zip(rows, fps, comps))
        got = simhash.simhash_dedup(docs).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert simhash.simhash_dedup(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0
    kept = simhash.keep_first(edge_docs).collect()
    assert edge_docs.columns == simhash.keep_first(edge_docs).columns
    assert {r.doc_id for r in kept} - {None} == {r.doc_id for r in simhash.simhash_dedup(edge_docs).where("kept").collect()}


def test_first_row_of_a_class_with_repeated_ids(spark):
    """A repeated id on unlike texts: each row stands for its own text."""
    alike = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, alike), (1, "one two three four five six seven"), (2, alike), (1, "one two three four five six seven"), (None, alike), (None, "nothing like the others at all")]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, (tuple(r) for r in kept))) == sorted(map(str, (rows[0], rows[1], rows[5])))


@pytest.mark.parametrize("hot", [False, True])
def test_hamming_links_equal_brute_force(spark, monkeypatch, hot):
    if hot:  # every top block beyond 16 rows is divided over pair tasks
        real = simhash.split_hot
        monkeypatch.setattr(simhash, "split_hot", lambda df, keys, row_id: real(df.repartition(2), keys, row_id, least=16))
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(25)}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.hamming_links(df).collect()
    mask = (1 << 64) - 1
    for e in edges:
        assert e.a != e.b
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for e in edges:
        a, b = root(e.a & mask), root(e.b & mask)
        label[max(a, b)] = min(a, b)
    got = [root(f) for f in fps]
    keys = list(fps)
    want = brute_components(keys, keys)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_quality_separates_and_draws_k(spark, edge_docs, no_docs, edge_labels):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit_on_labels(docs, labels)
    out = quality.resample(docs, model).withColumnRenamed("id", "doc_id").cache()
    held = out.join(labels, "doc_id").where(fold("doc_id", 5) == 0).collect()
    good = [r.selected for r in held if r.quality == 1]
    bad = [r.selected for r in held if r.quality == 0]
    assert np.mean(good) > 0.94 and np.mean(bad) < 0.3
    for k in (0, 1, 37, 10_000):
        top = sorted((r.key for r in out.where("n_tokens > 0").collect()), reverse=True)
        drawn = quality.resample(docs, model, k=k).where("selected").collect()
        assert len(drawn) == min(k, len(top))
        assert not drawn or min(r.key for r in drawn) >= top[len(drawn) - 1] - 1e-8
    kept = quality.keep_selected(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in out.where("selected").collect()}
    small = quality.fit(edge_docs, edge_labels)
    got = quality.resample(edge_docs, small).collect()
    assert len(got) == edge_docs.count() and not any(r.selected for r in got if r.n_tokens == 0)
    assert quality.keep_selected(edge_docs, small).columns == edge_docs.columns
    assert quality.resample(no_docs, quality.fit(no_docs, edge_labels)).count() == 0
    assert quality.keep_selected(no_docs, small).count() == 0


def test_language_held_out_and_mixture(spark, edge_docs, no_docs):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    got = queries.op9_language_id(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    docs = table(spark, sf, "documents")
    model = langid.fit(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 600 and 900").collect()}
    mixed = spark.createDataFrame([(1, by["en"] + " " + by["de"])], "doc_id long, text string")
    row = langid.identify(mixed, model).first()
    assert set(row.languages) == {"en", "de"} and abs(sum(row.shares) - 1) < 1e-6 and min(row.shares) > 0.3
    out = {r.id: r for r in langid.identify(edge_docs, model).collect()}
    assert len(langid.identify(edge_docs, model).collect()) == edge_docs.count()
    for i in (0, 1, 2, None, 11):
        assert (out[i].lang_pred, out[i].score, out[i].languages) == ("und", 0.0, [])
    assert langid.identify(no_docs, model).count() == 0
    none = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, none).collect()} == {"und"}
    kept = langid.keep_identified(edge_docs, model)
    assert kept.columns == edge_docs.columns and None not in {r.text for r in kept.collect()}


def test_language_set_of_a_text_in_four_languages(spark):
    docs = table(spark, SF_SMALL.replace("sf0.001", "sf0.01"), "documents")
    model = langid.fit(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 600 and 900").collect()}
    mixed = spark.createDataFrame([(1, " ".join(by[l] for l in ("en", "fr", "de", "es")))], "doc_id long, text string")
    row = langid.identify(mixed, model).first()
    assert set(row.languages) == {"en", "fr", "de", "es"} and abs(sum(row.shares) - 1) < 1e-6 and min(row.shares) > 0.1
    assert langid.keep_identified(mixed, model).count() == 0


def test_language_sets_of_any_size():
    """A row of five languages among six, and the best size of all when each size is fitted."""
    rng = np.random.default_rng(6)
    own = np.repeat(np.arange(5), 40)
    ll = np.where(own[:, None] == np.arange(6), 0.0, -9.0) + rng.normal(size=(200, 6)) * 0.1
    share = langid.infer(ll, np.array([0, 200]))
    assert set(np.flatnonzero(share[0])) == set(range(5)) and np.allclose(share[0, :5], 0.2, atol=0.01)


def test_mixture_matches_plain_em():
    rng = np.random.default_rng(0)
    ll = np.log(rng.dirichlet(np.ones(3), 40))
    ptr = np.array([0, 15, 40])
    share, like = langid.mixture(ll, ptr, np.full((2, 3), 1 / 3), 30)
    for d, (a, b) in enumerate([(0, 15), (15, 40)]):
        pi = np.full(3, 1 / 3)
        for _ in range(30):
            r = pi * np.exp(ll[a:b])
            pi = (r / r.sum(1, keepdims=True)).mean(0)
        assert np.allclose(share[d], pi, atol=1e-5)
        assert np.isclose(like[d], np.log((pi * np.exp(ll[a:b])).sum(1)).sum(), atol=1e-4)


def test_toxicity_held_out(spark, edge_docs, no_docs, edge_labels):
    sf = SF_SMALL.replace("sf0.001", "sf0.1")
    got = queries.op7_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    hit = [r.predicted for r in got if r.toxic == 1]
    false = [r.predicted for r in got if r.toxic == 0]
    assert np.mean(hit) > 0.8 and np.mean(false) < 0.02
    for docs, labels in ((edge_docs, edge_labels), (edge_docs, edge_labels.limit(0)), (no_docs, edge_labels)):
        model = toxicity.fit(docs, labels)
        out = toxicity.score(edge_docs, model).collect()
        assert len(out) == edge_docs.count() and all(0 <= r.score <= 1 for r in out)
        assert toxicity.score(no_docs, model).count() == 0


def test_toxicity_keeps_every_word_that_passes(spark):
    """400 rare insults pass the two tests; each of them alone raises a text's score."""
    rng = np.random.default_rng(4)
    bad, plain = [f"insult{i}" for i in range(400)], [f"word{i}" for i in range(3000)]
    texts = [" ".join([*rng.choice(plain, 20), *(rng.choice(bad, 14, replace=False) if i < 600 else [])]) for i in range(6600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 600)) for i in range(6600)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.buckets) >= 395  # a few share a bucket
    alone = spark.createDataFrame([(-1, "calm"), *enumerate(bad)], "doc_id long, text string")
    score = {r.id: r.score for r in toxicity.score(alone, model).collect()}
    assert all(score[i] > score[-1] for i in range(400))


def test_sparse_products_equal_dense_ones():
    rng = np.random.default_rng(5)
    x = (rng.random((50, 7)) < 0.3).astype(float)
    ones = toxicity.Ones(*np.nonzero(x), x.shape)
    assert np.allclose(ones @ np.arange(7.0), x @ np.arange(7.0)) and np.allclose(ones.T @ np.arange(50.0), x.T @ np.arange(50.0))
    y = x[:, 0] > 0
    w, b = toxicity.train_nnpu(x[y], x, 0.3)
    w2, b2 = toxicity.train_nnpu(toxicity.Ones(*np.nonzero(x[y]), x[y].shape), ones, 0.3)
    assert np.allclose(w, w2) and np.isclose(b, b2)


def test_nnpu_recovers_a_separable_rule():
    rng = np.random.default_rng(1)
    x = (rng.random((4000, 6)) < 0.3).astype(float)
    y = x[:, 0] > 0
    w, b = toxicity.train_nnpu(x[y][:300], x, float(y.mean()))
    assert (((x @ w + b) > 0) == y).mean() > 0.98


def test_language_sets_match_fitting_every_row():
    """The tangent bound and the runs of rows change no result: the same sets as when each row is fitted."""
    rng = np.random.default_rng(1)
    n = rng.integers(1, 60, 200)
    ptr = np.concatenate([[0], np.cumsum(n)])
    ll = np.log(rng.dirichlet(np.ones(4), ptr[-1]) ** 3 + 1e-9)
    for r in range(0, 200, 2):  # every other row leans to one language
        ll[ptr[r]:ptr[r + 1], r % 4] += 2.0
    ll[0] = [-1e5, -9e5, -8e5, -7e5]  # a word of very many n-grams
    plain = langid.infer(ll, ptr, checks=0, block=1 << 40)
    quick = langid.infer(ll, ptr, block=100)
    assert np.allclose(plain, quick, atol=1e-9) and np.isfinite(plain).all()
    assert {1, 2} <= set((plain > 0).sum(axis=1).tolist())


def test_language_trigrams_of_letter_runs():
    words = ["", "abc", "éáx1y-z", "́ab", "12", "ab\ncd", "İx", "日本語"]
    runs = [regex.findall(r"\p{L}[\p{L}\p{M}]*", w.lower()) for w in words]
    got = langid._grams([w.encode() for w in words])
    assert [len(g) // 4 for g in got] == [sum(map(len, r)) for r in runs]
    alone = langid._grams([r.encode() for rs in runs for r in rs])
    assert b"".join(alone) == b"".join(got)  # a run has the same trigrams wherever it stands
