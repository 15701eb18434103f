"""Chunk-reuse BPE, periodic runs and ranked search against the library and brute force."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from edge_rows import SF_SMALL, edge_docs, no_docs  # noqa: F401
from panelspark.llm import balltree, chunkbpe, queries, wordruns
from panelspark.llm.common import table

BYTES = P.path("byte_bpe_50k.json")


def sha(x):
    return hashlib.sha256(x).hexdigest()


@pytest.fixture(scope="module")
def lib():
    return tokenizers.Tokenizer.from_file(BYTES)


@pytest.mark.parametrize("bits", [1, 2, 6])
@settings(max_examples=120, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("abthe ing \n\t\r \u0085\x1c  　é1!'.,sİΣ日💩l<|>"), max_size=160), max_size=4))
def test_chunks_give_the_librarys_ids(lib, bits, texts):
    texts = [*texts, None, "of a <|endoftext|> we'll see<|endoftext|>", "".join(t or "" for t in texts)]
    enc = chunkbpe.encoder(BYTES, bits)
    ids, ptr = enc.encode_column(pa.array(texts, pa.string()))
    back = enc.decode_flat(ids.astype(np.int64), ptr)
    for t, a, b, raw in zip(texts, ptr, ptr[1:], back):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert ids[a:b].tolist() == want
        assert raw.decode() == lib.decode(want, skip_special_tokens=False) == (t or "")


def test_cuts_follow_the_content():
    rng = random.Random(5)
    passage = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(80)).encode()
    pieces = []
    for head in (b"x" * 7, b"some other beginning, ", b""):
        data = np.frombuffer(head + passage, np.uint8)
        starts = chunkbpe.cuts(data, np.array([0, len(data)]), 4).tolist() + [len(data)]
        pieces.append({data[a:b].tobytes() for a, b in zip(starts, starts[1:])})
    assert len(pieces[0] & pieces[1] & pieces[2]) >= len(pieces[2]) - 3  # all but those at the beginning
    one = np.frombuffer(b"a" * 5000, np.uint8)
    assert len(chunkbpe.cuts(one, np.array([0, 5000]), 1)) <= 2


def test_chunk_bpe_rows(spark, edge_docs, no_docs, lib):
    for docs in (edge_docs, table(spark, SF_SMALL, "documents")):
        got = sorted(map(str, queries_rows(chunkbpe.round_trip(docs, BYTES))))
        want = []
        for r in docs.collect():
            ids = lib.encode(r.text or "", add_special_tokens=False).ids
            want.append(str((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode()))))
        assert got == sorted(want)
    assert chunkbpe.round_trip(no_docs, BYTES).count() == 0
    back = chunkbpe.decode(chunkbpe.encode(edge_docs, BYTES), BYTES).collect()
    assert sorted((str(r.id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in edge_docs.collect())


def queries_rows(df):
    return [tuple(r) for r in df.collect()]


def brute_runs(s, least=24, periods=3):
    """Every maximal stretch with words q apart identical whose smallest period is q."""
    out = set()
    for q in range(1, len(s) // periods + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, periods * q):
                part = s[i:j + q]
                if not any(all(part[k] == part[k + p] for k in range(size - p)) for p in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i) + 1
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.lists(st.integers(0, 3), max_size=30), st.integers(1, 12), st.integers(0, 70), st.lists(st.integers(0, 3), max_size=20))
def test_runs_equal_brute_force(letters, head, period, size, tail):
    s = [x % letters for x in head]
    unit = (s + [0, 1, 0, 0, 2])[:period]
    s += [unit[k % len(unit)] for k in range(size)] + tail
    words = np.array(s, dtype=np.int64)
    for least, periods in ((2, 2), (24, 3)):
        assert [tuple(x) for x in wordruns.runs(words, least, periods).tolist()] == brute_runs(s, least, periods)
    keep = wordruns.possible(words, np.array([0, len(s)]))
    assert [tuple(x) for x in wordruns.runs_between(words, keep).tolist()] == brute_runs(s)


def brute_digest(doc_id, text, planted):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    gone = {i for a, size, q in found for i in range(a + q, a + size)}
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone).encode()))


def test_periodic_runs_rows(spark, edge_docs, no_docs):
    """Some documents of the given table (the brute force is quadratic), all of the odd ones."""
    short = table(spark, SF_SMALL, "documents").where("length(text) < 6000").union(
        spark.createDataFrame([(10 ** 6 + i, "a b c " * k, None, None, 0) for i, k in enumerate(range(4, 60, 5))], "doc_id long, text string, lang string, source string, n_chars int"))
    for docs, planted in ((edge_docs.where("length(text) < 6000 or text is null"), False), (short, True)):
        got = wordruns.periodic_runs(docs, planted=planted, outputs=False).drop("runs", "collapsed")
        want = [brute_digest(r.doc_id, r.text, planted) for r in docs.collect()]
        assert sorted(map(str, queries_rows(got))) == sorted(map(str, want))
        assert any(w[1] for w in want) == planted
    out = {r.id: r for r in wordruns.periodic_runs(edge_docs).collect()}
    long = next(r for r in out.values() if r.n_runs)
    assert (long.start, long.length, long.period, long.exponent_milli) == (0, 30_000, 1, 30_000_000)
    assert [tuple(x) for x in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    assert wordruns.periodic_runs(no_docs).count() == 0
    assert queries.op12_periodic_runs(spark, SF_SMALL).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def brute_search(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def cut(text):
        return term.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    rows = [(i, cut(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in rows if t), sum(len(t) for _, t in rows)
    df = {}
    for _, t in rows:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        asked, scored = cut(text), []
        for i, t in rows:
            m = 75 + 25 * len(t) * n_docs // n_terms if n_terms else 75
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10 ** 9 * t.count(x) // (1000 * t.count(x) + 12 * m)) for x in asked if x in t)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("blocks", [False, True])
def test_ranked_search_equals_brute_force(spark, edge_docs, blocks):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(60)] + ["é1", "日本", "Ab"]
    rows = [(i, " ".join(rng.choices(words[:rng.randint(3, 63)], k=rng.choice([1, 3, 20, 90])))) for i in range(700)]
    rows += [(5000 + i, "w1 w2, W3 é1! w1") for i in range(60)] + [(None, "w1 w2 w3"), (1, rows[1][1]), (2000, None), (2001, ""), (2002, " .,")]
    rows += [(r.doc_id, r.text) for r in edge_docs.collect()]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 8, 30])))) for i in range(25)] + [(30, None), (31, ""), (32, "word WORD x"), (33, "nowhere")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item_id", "2.0 as score").repartition(3)
    asked = spark.createDataFrame(items + items[:3], "item_id long, text string").selectExpr("*", "3 as doc_id")
    for tree, sample in ((50, 4), (4096, 1)):
        got = balltree.ranked_search(docs, asked, k=20, query_bytes=100 if blocks else 1 << 20, tree=tree, sample=sample)
        assert sorted(queries_rows(got), key=str) == sorted(brute_search(rows, items, 20), key=str)


def test_ranked_search_of_nothing(spark, no_docs, edge_docs):
    items = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    assert balltree.ranked_search(no_docs, items).count() == 0
    assert balltree.ranked_search(edge_docs, items.limit(0)).count() == 0
    assert balltree.ranked_search(edge_docs, items).count() == 5  # four rows of one text and the one with another sign


def test_bounds_hold_and_prune():
    """No document scores above the bound of any node over it, and copies far from a query are not scored."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{'ab'[i % 2]}{w}" for w in rng.zipf(1.5, 12) % 40) for i in range(30)]
    q = balltree.Queries(texts)
    width = len(q.vocab)
    rows = [np.unique(rng.integers(0, width, rng.integers(1, 25))) for _ in range(400)]
    ptr, cols = np.cumsum([0] + [len(r) for r in rows]), np.concatenate(rows)
    q.weigh(np.bincount(cols, minlength=width), 400)
    x = rng.integers(1, 900_000, len(cols))
    tree = balltree.BallTree(ptr, cols, x, q, leaf=8)
    exact = tree.score(np.arange(400), q.asked)

    def under(node):
        return tree.leaves[node] if node in tree.leaves else np.concatenate([under(c) for c in tree.below[node]])

    for node in range(len(tree.bounds)):
        assert (exact[:, under(node)] <= tree.bounds[node][:, None]).all()
    seen, score = [], tree.score
    tree.score = lambda d, r: seen.append(len(d) * len(r)) or score(d, r)
    got = tree.search(np.zeros(30, np.int64), 3)
    best = np.sort(exact, axis=1)[:, ::-1][:, :3]
    for i in range(30):
        assert sorted(got[2][got[0] == q.asked[i]].tolist(), reverse=True)[:3] == best[i].tolist()
    assert sum(seen) < 400 * 30
