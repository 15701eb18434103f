"""Ranked lexical search as exact inner-product search in sparse ball trees.

A document is a sparse vector over the terms of the queries, a query another one, and the score their inner
product in whole numbers. Each task deals its documents to ball trees. A node knows its centroid and its radii: one
for each block of coordinates, so that a query's few terms meet only the spread of their own blocks. By
Cauchy-Schwarz no document below scores more than the centroid's product plus, over the blocks, radius times
norm of the query; the bound is rounded up beyond all errors of floating point. Each query opens the node of highest bound
first and ends when that is under the k-th best score known; leaves are scored with 64-bit integers.

A first search over one document in ``SAMPLE`` gives every query a proven lower bound of its k-th score; the
search over all documents starts from there, so that a task returns few rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.llm.common import map_rows, reliable_checkpoint, slices, text_bytes

LEAF = 32  # documents scored at once
TREE = 4096  # documents of a tree
BLOCKS = 256  # blocks of coordinates with a radius each
SAMPLE = 16  # one document in so many gives the first bounds
QUERY_BYTES = 1 << 20  # query texts searched at once
SLACK = 1e-9  # relative rounding of bounds; sums of doubles here are exact to 1e-12 and better

#: separators (all ASCII but letters and digits) become blanks, A-Z become a-z
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


class Queries:
    """A block of queries as sparse rows over their own vocabulary."""

    def __init__(self, texts: list[str | None]):
        self.vocab: dict[bytes, int] = {}
        cols, times, ptr = [], [], [0]
        for text in texts:
            mine: dict[int, int] = {}
            for t in terms(text):
                c = self.vocab.setdefault(t, len(self.vocab))
                mine[c] = mine.get(c, 0) + 1
            cols += mine.keys()
            times += mine.values()
            ptr.append(len(cols))
        self.cols, self.times, self.ptr = np.array(cols, dtype=np.int64), np.array(times, dtype=np.int64), np.array(ptr)

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Term weights from document frequencies; queries without a term are never asked."""
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
        self.gain = self.times * self.weight[self.cols]
        root = np.sqrt(self.weight.astype(np.float64))
        self.root, self.u = root, self.times * root[self.cols]
        row = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        squares = np.bincount(row * BLOCKS + self.cols % BLOCKS, weights=self.u ** 2, minlength=(len(self.ptr) - 1) * BLOCKS)
        self.block_norm = np.sqrt(squares.reshape(-1, BLOCKS))
        self.asked = np.flatnonzero(np.diff(self.ptr))

    def sums(self, values: np.ndarray, rows: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Sums of ``values`` over the entries of each of ``rows`` (none empty); ``flat`` lists the entries."""
        return np.add.reduceat(values, np.cumsum(np.diff(self.ptr)[rows]) - np.diff(self.ptr)[rows], axis=0)

    def entries(self, rows: np.ndarray) -> np.ndarray:
        return ranges(self.ptr[rows], self.ptr[rows + 1])


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [lo, hi) one after the other."""
    size = hi - lo
    ends = np.cumsum(size)
    return np.repeat(lo - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def values(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's value of a term: (1e9 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * n * n_docs) div n_terms."""
    if len(n) and 25 * int(n.max()) * n_docs >= 1 << 62:
        m = np.array([75 + 25 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
    else:
        m = 75 + 25 * n * n_docs // max(n_terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class BallTree:
    """A tree over documents given as sparse rows (``ptr``, ``cols``, whole-number ``x``) with the
    queries' bounds of every node."""

    def __init__(self, ptr: np.ndarray, cols: np.ndarray, x: np.ndarray, queries: Queries, leaf: int = LEAF):
        self.queries, self.asked = queries, queries.asked
        self.ptr, self.cols, self.x = ptr, cols, x
        self.y = x * queries.root[cols]
        self.square = np.add.reduceat(self.y ** 2, ptr[:-1])
        flat = queries.entries(self.asked)
        self.leaves: dict[int, np.ndarray] = {}
        self.below: dict[int, tuple[int, int]] = {}
        bounds = []
        todo = [(np.arange(len(ptr) - 1), None)]
        while todo:
            docs, parent = todo.pop()
            node = len(bounds)
            if parent is not None:
                self.below[parent] = (*self.below.get(parent, ()), node)
            centre, dist = self.ball(docs)
            reach = queries.sums(queries.u[flat] * centre[queries.cols[flat]], self.asked, flat)
            spread = queries.block_norm[self.asked] @ dist
            bounds.append(np.floor((reach + spread) * (1 + SLACK)) + 1)
            if len(docs) <= leaf:
                self.leaves[node] = docs
                continue
            far = docs[self.distance(docs, centre).argmax()]
            a = self.distance(docs, self.dense(far))
            b = self.distance(docs, self.dense(docs[a.argmax()]))
            order = (a - b).argsort(kind="stable")
            todo += [(docs[order[len(docs) // 2:]], node), (docs[order[:len(docs) // 2]], node)]
        self.bounds = np.array(bounds)

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the documents, and for each the place of its document among them."""
        at = ranges(self.ptr[docs], self.ptr[docs + 1])
        return at, np.repeat(np.arange(len(docs)), self.ptr[docs + 1] - self.ptr[docs])

    def dense(self, doc: int) -> np.ndarray:
        out = np.zeros(len(self.queries.weight))
        at = slice(self.ptr[doc], self.ptr[doc + 1])
        out[self.cols[at]] = self.y[at]
        return out

    def distance(self, docs: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Squared distances of the documents to a point (used to divide them only)."""
        at, row = self.rows(docs)
        return self.square[docs] - 2 * np.bincount(row, weights=self.y[at] * point[self.cols[at]], minlength=len(docs)) + point @ point

    def ball(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid of the documents and the radius of each block of coordinates, not too small by rounding."""
        at, row = self.rows(docs)
        cols, y = self.cols[at], self.y[at]
        centre = np.bincount(cols, weights=y, minlength=len(self.queries.weight)) / len(docs)
        block = np.bincount(np.arange(len(centre)) % BLOCKS, weights=centre ** 2, minlength=BLOCKS)
        key = row * BLOCKS + cols % BLOCKS
        own = np.bincount(key, weights=(y - centre[cols]) ** 2 - centre[cols] ** 2, minlength=len(docs) * BLOCKS)
        size = np.bincount(key, weights=y ** 2, minlength=len(docs) * BLOCKS)
        most, large = own.reshape(-1, BLOCKS).max(axis=0), size.reshape(-1, BLOCKS).max(axis=0)
        return centre, np.sqrt(np.maximum(most + block, 0) + 1e-12 * (large + block))

    def score(self, docs: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores (queries x documents) in 64-bit integers."""
        at, row = self.rows(docs)
        present, local = np.unique(self.cols[at], return_inverse=True)
        table = np.zeros((len(present) + 1, len(docs)), np.int64)
        table[local, row] = self.x[at]
        flat = self.queries.entries(rows)
        c = self.queries.cols[flat]
        where = np.searchsorted(present, c)
        where[present[np.minimum(where, len(present) - 1)] != c] = len(present)
        return self.queries.sums(table[where] * self.queries.gain[flat][:, None], rows, flat)

    def search(self, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, score) of the documents whose score is above 0, at least the query's ``floor``, and not
        under the k-th best in this tree; best node first, all queries side by side."""
        asked = self.asked
        best = np.zeros((len(asked), k), np.int64)
        least = np.maximum(floor[asked], 1)
        front = np.full(self.bounds.T.shape, -1.0)
        front[:, 0] = self.bounds[0]
        out = []
        live = np.arange(len(asked))
        while len(live):
            pick = front[live].argmax(axis=1)
            going = front[live, pick] >= least[live]
            live, pick = live[going], pick[going]
            front[live, pick] = -1.0
            order = pick.argsort(kind="stable")
            nodes, at = np.unique(pick[order], return_index=True)
            for node, mine in zip(nodes.tolist(), np.split(live[order], at[1:])):
                if node not in self.leaves:
                    for child in self.below[node]:
                        front[mine, child] = self.bounds[child][mine]
                    continue
                docs = self.leaves[node]
                got = self.score(docs, asked[mine])
                q, d = np.nonzero(got >= least[mine][:, None])
                if not len(q):
                    continue
                out.append((mine[q], docs[d], got[q, d]))
                some = np.unique(q)
                top = np.concatenate([best[mine[some]], got[some]], axis=1)
                best[mine[some]] = -np.partition(-top, k - 1, axis=1)[:, :k]
                least[mine[some]] = np.maximum(least[mine[some]], best[mine[some]].min(axis=1))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        q, d, s = map(np.concatenate, zip(*out))
        keep = s >= least[q]
        return asked[q[keep]], d[keep], s[keep]


def _vectors(batches, vocab):
    """Rows of term counts: the entries of each text that are terms of the queries."""
    width = max(len(vocab), 1)
    for batch in slices(batches, "text"):
        raw, offs = text_bytes(batch.column("text"))
        raw, offs = raw.tobytes().translate(_FOLD), offs.tolist()
        known, n, sizes = [], [], []
        for a, b in zip(offs, offs[1:]):
            words = raw[a:b].split()
            n.append(len(words))
            mine = [vocab[w] for w in words if w in vocab]
            sizes.append(len(mine))
            known += mine
        key = np.repeat(np.arange(len(n)), sizes) * width + np.array(known, dtype=np.int64)
        key, tf = np.unique(key, return_counts=True)
        ptr = pa.array(np.searchsorted(key // width, np.arange(len(n) + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array(n, pa.int64()),
            pa.ListArray.from_arrays(ptr, pa.array((key % width).astype(np.int32))),
            pa.ListArray.from_arrays(ptr, pa.array(tf.astype(np.int32)))], names=["id", "n", "cols", "tf"])


def _frequencies(batches, width):
    df = np.zeros(width, np.int64)
    for batch in batches:
        df += np.bincount(np.asarray(batch.column("cols").flatten()), minlength=width)
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])


def _search(batches, queries, n_docs, n_terms, floor, k, tree):
    """Trees of up to ``tree`` documents each over a task's rows; those without a term of the queries score nothing."""
    held: list[pa.RecordBatch] = []

    def answer():
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        lists = rows.column("cols").chunk(0)
        size = np.asarray(lists.value_lengths())
        ids = rows.column("id").chunk(0)
        ptr = np.concatenate([[0], np.cumsum(size)])
        tf = np.asarray(rows.column("tf").chunk(0).flatten()).astype(np.int64)
        x = values(tf, np.repeat(np.asarray(rows.column("n").chunk(0)), size), n_docs, n_terms)
        ball = BallTree(ptr, np.asarray(lists.flatten()).astype(np.int64), x, queries)
        q, d, s = ball.search(floor, k)
        # the k best of each query: highest score, then smallest id, rows without id last
        null = np.asarray(ids.is_null())
        key = np.asarray(ids.fill_null(0))
        order = np.lexsort((key[d], null[d], -s, q))
        q, d, s = q[order], d[order], s[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, d, s = q[place < k], d[place < k], s[place < k]
        return pa.RecordBatch.from_arrays([pa.array(q), ids.take(pa.array(d)), pa.array(s)], names=["query", "doc_id", "score"])

    count = 0
    for batch in batches:
        batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("cols")), 0))
        while batch.num_rows:
            part = batch.slice(0, tree - count)
            batch = batch.slice(part.num_rows)
            held.append(part)
            count += part.num_rows
            if count == tree:
                yield answer()
                count = 0
    if count:
        yield answer()


def query_blocks(items: DataFrame, size: int) -> Iterator[list[Row]]:
    """The rows of ``items`` in blocks of about ``size`` bytes of text, one at a time on the driver."""
    block, held = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        held += len(row.text or "")
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", query_bytes: int = QUERY_BYTES, tree: int = TREE, sample: int = SAMPLE) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of each item, equal scores by ascending id.

    Terms, weights and scores are those stated in ``terms``, ``Queries.weigh`` and ``values``; only scores above 0 count, so an
    item without a term, or whose terms stand in no document, has no rows. Statistics cover all documents.

    Items are a stated query set, taken in blocks of about ``query_bytes`` of text: a block, its vocabulary and the document
    frequencies of that vocabulary are all that driver and tasks hold of them, whatever the number of items. Documents stay where
    they are read; no document vector is shuffled.

    A null or empty text has no term; a null doc_id ranks behind other ids of its score. Rows that repeat a doc_id are documents of
    their own. Rows of items equal in id and text are one query; one id with several texts is ranked for each text
    separately; a null item_id is a query like any other. Other columns make no difference; empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(doc_text).cast("string").alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text")).distinct()
    parts = []
    for block in query_blocks(asked, query_bytes):
        queries = Queries([r.text for r in block])
        if not queries.vocab:
            continue
        width = len(queries.vocab)
        vectors = reliable_checkpoint(map_rows(rows, partial(_vectors, vocab=queries.vocab), "id long, n long, cols array<int>, tf array<int>"))
        n_docs, n_terms = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(width, np.int64)
        counted = map_rows(vectors.select("cols"), partial(_frequencies, width=width), "term int, df long").groupBy("term").agg(F.sum("df"))
        for term, count in counted.collect():  # at most the vocabulary of one block
            df[term] = count
        queries.weigh(df, n_docs)
        queries.vocab = {}
        look = partial(_search, queries=queries, n_docs=n_docs, n_terms=n_terms, k=k, tree=tree)
        floor = np.zeros(len(block), np.int64)
        best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        if sample > 1:
            first = vectors.where(F.pmod(F.xxhash64("id"), F.lit(sample)) == 0)
            found = map_rows(first, partial(look, floor=floor), "query long, doc_id long, score long")
            for q, s in found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query", "score").collect():
                floor[q] = s
        found = map_rows(vectors, partial(look, floor=floor), "query long, doc_id long, score long")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item) for i, r in enumerate(block)], "query long, item_id long")
        parts.append(reliable_checkpoint(found.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

ORACLE = f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} AS term FROM documents) GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, total GROUP BY term),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""
