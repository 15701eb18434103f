"""Extraction, chat, embeddings, graph search, components and the pipeline."""

import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from edge_rows import SF_SMALL, edge_docs, no_docs  # noqa: F401
from panelspark.llm import boosting, chat, components, embeddings, extraction, graphsearch, langid, quality, queries, simhash
from panelspark.llm.common import fold, table
from panelspark.llm.dom import Dom, Forest

SF = SF_SMALL.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def page_model(spark):
    return extraction.fit(table(spark, SF, "pages"), max_pages=200)


def test_extraction_of_pages_and_remakes(spark, page_model):
    pages = [r.html for r in table(spark, SF, "pages").collect()]
    want = ["\n".join(x for _, x in extraction.page_lines(p)) for p in pages]
    assert np.mean([a == b for a, b in zip(extraction.extract_batch(pages, page_model), want)]) > 0.97
    rng = random.Random(5)
    pool = [x for p in pages[:50] for _, x in extraction.page_lines(p)]
    lines = [extraction.page_lines(p) for p in pages[200:]]
    made = [extraction.variant(x, pool, rng).replace(" x-bad=1", "") for x in lines]
    got = extraction.extract_batch(made, page_model)
    assert np.mean([a == "\n".join(x for _, x in b) for a, b in zip(got, lines)]) > 0.8


def test_extraction_edges(spark, page_model):
    rows = [(None, None, None), (1, "u", ""), (2, "u", "plain words &amp; more"), (3, "u", "<p>" * 3000 + "deep"), (2, "u", "plain words &amp; more"),
            (4, None, "<script>x</script><style>y</style><!-- z -->"), (5, "u", "<div><b>a<br>b</div></b></p><p>c  d")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = extraction.extract(df, page_model).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (None, 1, 4)} == {""}
    assert extraction.extract(df.limit(0), extraction.fit(df.limit(0))).count() == 0


def test_decode_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(30):
        f = Forest([Dom("<div><p>a</p><p>b<i>c</i></p></div>")])
        gain = rng.normal(size=len(f.tags))
        got = f.decode(gain, bond=0.0)
        best = max(sum(gain[i] for i in range(len(gain)) if m >> i & 1) for m in range(1 << len(gain))
                   if all(f.root[i] or m >> int(f.parent[i]) & 1 for i in range(len(gain)) if m >> i & 1))
        assert np.isclose(gain[got].sum(), best) and all(f.root[i] or got[f.parent[i]] for i in np.flatnonzero(got))


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.train(x[:2000], y[:2000])
    assert ((model.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95


#: pages written by hand, and the text that a reader would call their main text
HAND = [
    ("""<html><head><title>T</title><script>var a = 1;</script></head><body><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav>
     <article><h1>A walk</h1><p class="formatted">We left at <b>dawn</b> and saw&nbsp;the sea, then went on to the village by the bay.</p>
     <p id="morella">Let <math><mi>x</mi></math> be the number of birds that we counted on the long way home that day.</p></article>
     <footer>&copy; 2020 Somebody. All rights reserved.</footer></body></html>""",
     "A walk\nWe left at dawn and saw the sea, then went on to the village by the bay.\nLet x be the number of birds that we counted on the long way home that day."),
    ("""<body><header><a href="/">Site</a></header><div class="menu"><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div>
     <article><p>The first paragraph is long enough to be read as the text of an article on this page.</p><ul><li>An item of a list that belongs to it</li></ul>
     <object><p>Words that stand inside an object element of the article and belong to its text.</p></object></article>
     <div class="comments"><p>First!</p><p>I disagree with all of this.</p></div><form><label>Search</label><input name=q><button>Go</button></form></body>""",
     "The first paragraph is long enough to be read as the text of an article on this page.\nAn item of a list that belongs to it\n"
     "Words that stand inside an object element of the article and belong to its text."),
]


def test_extraction_of_hand_written_pages(spark):
    """Expected texts that no labeller made; the model learns from the given pages."""
    model = extraction.fit(table(spark, SF, "pages"))
    assert extraction.extract_batch([h for h, _ in HAND], model) == [t for _, t in HAND]


def test_extraction_without_a_labelled_page():
    """No page names its article: remakes of the pages' lines teach the model what menus and footers are."""
    page = "<nav><a href=/>Home</a> <a href=/x>More</a></nav><div><p>Hello world, this is a line of text that one may read.</p></div><footer>c 2020</footer>"
    for pages in ([page], [page] * 60, []):
        assert extraction.extract_batch([page], extraction.train(pages)) == ["Hello world, this is a line of text that one may read."]


def test_extraction_of_a_deep_page_is_linear():
    import time

    deep = "<div>" * 40_000 + "<p>the bottom</p>" + "</div>" * 40_000
    t0 = time.perf_counter()
    forest = extraction.Forest([extraction.Dom(deep)])
    forest.features()
    chosen = forest.decode(np.ones(len(forest.tags)))
    assert forest.page_texts(chosen) == ["the bottom"] and time.perf_counter() - t0 < 10


def test_chat_perspectives(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "é💩"), (1, 3, "ann", "é💩"), (None, 0, "ann", "x"),
            (2, None, "ann", "late"), (2, 5000, None, "who"), (2, 1, "bob", ""), (3, 0, "system", "alone")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {(r.conv_id, r.part, r.speaker): r for r in chat.perspectives(df).collect()}
    assert set(got) == {(c, 0, s) for c in (1, 2) for s in ("ann", "bob")}
    one = got[1, 0, "ann"]
    assert one.text.startswith("<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n")
    assert [one.text[s.start:s.stop] for s in one.spans] == ["hi<|im_end|>", "é💩<|im_end|>", "é💩<|im_end|>"]
    con = duckdb.connect()
    con.register("conversations", df.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = {(r.conv_id, r.part, r.speaker): r for r in con.sql(chat.ORACLE).df().itertuples()}
    for k, r in got.items():
        assert (r.text, r.mask, r.n_own, r.masked_chars) == (want[k].text, want[k].mask, want[k].n_own, want[k].masked_chars)
    assert set(want) == set(got) and chat.perspectives(df.limit(0)).count() == 0
    assert "Python" not in chat.perspectives(df)._jdf.queryExecution().toString() and "Arrow" not in chat.perspectives(df)._jdf.queryExecution().toString()


def test_long_dialogues_are_parted_by_place(spark):
    """Time-stamped turns stay together; a long dialogue is cut by the places of its turns, whatever their numbers."""
    rng = np.random.default_rng(4)
    rows = [(1, 3000 * k, ["ann", "bob"][k % 2], f"m{k}") for k in range(6)]
    rows += [(2, int(rng.integers(0, 40)) if k % 3 else None, ["ann", "bob", "cy", None][k % 4], f"t{k % 11}") for k in range(500)]
    rows += [(3, None, "ann", "same")] * 130 + [(4, k, "dan", "x") for k in range(64)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = chat.perspectives(df, part_turns=64).collect()
    texts = {(r.conv_id, r.part, r.speaker): r.text for r in got}
    assert {k for k in texts if k[0] != 2} == {(1, 0, "ann"), (1, 0, "bob"), (3, 0, "ann"), (3, 1, "ann"), (3, 2, "ann"), (4, 0, "dan")}
    order = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:])
    for speaker in ("ann", "bob", "cy"):
        turns = sorted((r for r in rows if r[0] == 2), key=order)
        whole = "".join("<|im_start|>" + ("assistant" if role == speaker else "user" if role is None else f"user name={role}") + f"\n{text}<|im_end|>\n" for _, _, role, text in turns)
        assert "".join(texts[2, p, speaker] for p in range(8)) == whole
    assert all(r.n_turns <= 64 for r in got) and sum(r.n_turns for r in got if r.speaker == "ann") == 6 + 500 + 130


def vectors(n=300, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 4):
        x[i + 1] = x[i] + rng.normal(size=dim) * rng.choice([0.02, 0.1, 0.3])
    x[10:30] = x[8]
    return x


BAD = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [None], [float("inf")] + [1.0] * 15]


def frame(spark, x):
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(BAD)] + [(None, x[0].tolist()), (5, x[5].tolist())]
    return spark.createDataFrame([(*r, 1, 7) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")


@pytest.mark.parametrize("hot", [False, True])
def test_embedding_links_equal_brute_force(spark, monkeypatch, hot):
    if hot:
        real = embeddings.split_hot
        monkeypatch.setattr(embeddings, "split_hot", lambda df, keys, row_id: real(df.repartition(2), keys, row_id, least=4))
    x = vectors()
    df = frame(spark, x)
    ids = [*range(len(x)), None, 5]
    full = np.vstack([x, x[0], x[5]])
    u = full / np.linalg.norm(full, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(full))
    np.fill_diagonal(near, True)
    for _ in range(len(full)):
        label = np.array([label[r].min() for r in near])
    comp = {c: min(i for i, k in zip(ids, label) if k == c and i is not None) for c in set(label)}
    want = sorted((str(i), int(near[k].sum()) - 1, comp[label[k]]) for k, i in enumerate(ids))
    got = embeddings.embedding_dedup(df, recall=0.9999).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got if not (r.vec_id or 0) >= 1000) == want
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in got if (r.vec_id or 0) >= 1000)
    assert len(got) == df.count() and embeddings.embedding_dedup(df.limit(0)).count() == 0


def test_embedding_query_finds_pairs_at_the_threshold(spark, tmp_path):
    """The registered query, with its own settings, on 1,000 pairs just above cosine 0.95."""
    rng = np.random.default_rng(3)
    a, b = (rng.normal(size=(1000, 32)) for _ in range(2))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    x = np.vstack([a, 0.9501 * a + np.sqrt(1 - 0.9501 ** 2) * b])
    near = x @ x.T >= 0.95
    assert near.sum() == 4000  # each with itself and its partner
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    got = queries.op6_embedding_dedup(spark, str(tmp_path)).collect()
    linked = [r for r in got if r.n_links]
    assert all((r.n_links, r.component_id) == (1, r.vec_id % 1000) for r in linked) and len(got) == 2000
    assert len(linked) / 2000 >= 0.999  # 0.9999 expected, and one pair of chance


def test_graph_search_recall_and_order(spark):
    e = table(spark, SF, "embeddings")
    rows = e.collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    ids = np.array([r.vec_id for r in rows])
    got = {}
    for r in graphsearch.nearest(e, shard_rows=200).collect():
        got.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        order = sorted((-s[j], ids[j]) for j in range(len(ids)) if j != i)[:20]
        mine = sorted(got[ids[i]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [(r.score, r.vec_id) for r in mine] == sorted(((r.score, r.vec_id) for r in mine), key=lambda t: (-t[0], t[1]))
        hits += len({r.vec_id for r in mine} & {v for _, v in order})
        total += 20
        assert all(abs(r.score - s[list(ids).index(r.vec_id)]) < 1e-9 for r in mine)
    assert hits / total >= 0.9


def test_graph_search_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(12)
    x = rng.choice([-1.0, 1.0], size=(2000, 16))
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]
    got = graphsearch.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    mine: dict = {}
    for r in sorted(got, key=lambda r: r.rank):
        mine.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q, ids in mine.items():
        s = x @ x[q]
        hits += len(set(ids) & {j for _, j in sorted((-s[j], j) for j in range(len(x)) if j != q)[:20]})
    assert hits / (20 * len(mine)) >= 0.95


def test_graph_search_edges(spark):
    x = vectors(40)
    df = frame(spark, x * np.linspace(0.1, 9, 40)[:, None])
    got = graphsearch.nearest(df, every=2, k=50).collect()
    per = {q: [r.vec_id for r in got if r.query_id == q] for q in {r.query_id for r in got}}
    assert set(per) == set(range(0, 40, 2)) and all(len(v) == len(set(v)) == 39 and q not in v for q, v in per.items())
    assert graphsearch.nearest(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 4)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages_follow_their_operators(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = quality.resample(docs, quality.fit_on_labels(docs, labels)).where("selected").select("id").collect()
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert {r.id for r in good} == {r.doc_id for r in first.select("doc_id").collect()}
    bad = labels.where("quality = 0").count()
    assert first.join(labels.where("quality = 0"), "doc_id").count() < 0.15 * bad
    second = corpus_pipeline.STAGES[1][1](spark, first, SF)
    known = langid.identify(first, langid.fit(first, use=fold("doc_id", 4) != 2)).where("lang_pred <> 'und' and score >= 0.5")
    assert {r.id for r in known.collect()} == {r.doc_id for r in second.select("doc_id").collect()}
    third = corpus_pipeline.STAGES[2][1](spark, second, SF)
    assert {r.doc_id for r in simhash.simhash_dedup(second).where("kept").collect()} == {r.doc_id for r in third.select("doc_id").collect()}
    for stage in (first, second, third):
        assert stage.columns == docs.columns
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in third.select("doc_id").collect()}


def test_pipeline_stages_take_edge_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        at = docs
        for name, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, SF)
            assert name == "packing" or at.columns == docs.columns
        at.collect()
