"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beam.

Vectors are dealt to shards by hash. Each shard builds a graph: a greedy beam search for every
node proposes neighbours, and relaxed distance pruning keeps a candidate only if no kept
neighbour is nearer to it by the factor ``alpha``, so the edges kept are diverse. Largest inner
product becomes smallest distance by one more coordinate that brings all vectors to one length.
All steps work on blocks of nodes or queries at once.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.llm.common import reliable_checkpoint, ship_package
from panelspark.llm.embeddings import sound

DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2


def beam_search(x: np.ndarray, sq: np.ndarray, graph: np.ndarray, entry: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes met by a best-first walk from ``entry``, per query: (nodes,
    squared distances less the query's own square), nearest first; -1 where fewer were met.

    A step expands each query's nearest unexpanded node of the beam; a query ends when its beam
    holds none. Of nodes at one distance the beam keeps the smaller numbers.
    """
    m, n = len(q), len(x)
    tie = 1e-9 * (float(sq.max(initial=0)) + 1e-30) / max(n, 1)  # far below the spacing of distances
    seen = np.zeros((m, n), bool)
    start = np.tile(entry, (m, 1))
    d0 = sq[entry][None, :] - 2 * (q @ x[entry].T)
    width = max(beam, len(entry))
    nodes = np.full((m, width), -1)
    dist = np.full((m, width), np.inf, np.float32)
    order = d0.argsort(axis=1, kind="stable")
    nodes[:, :len(entry)] = np.take_along_axis(start, order, 1)
    dist[:, :len(entry)] = np.take_along_axis(d0, order, 1)
    seen[:, entry] = True
    expanded = nodes < 0
    live = np.arange(m)
    while len(live):
        todo = np.where(expanded[live], np.inf, dist[live])
        pick = todo.argmin(axis=1)
        going = np.isfinite(todo[np.arange(len(live)), pick])
        live, pick = live[going], pick[going]
        if not len(live):
            break
        expanded[live, pick] = True
        near = graph[nodes[live, pick]]
        new = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(near >= 0, near, near.max(axis=1, keepdims=True).clip(0))] = True
        cand = x[near]
        d = sq[near] - 2 * np.einsum("ijk,ik->ij", cand, q[live], optimize=True)
        d = np.where(new, d, np.inf).astype(np.float32)
        alln = np.concatenate([nodes[live], near], axis=1)
        alld = np.concatenate([dist[live], d], axis=1)
        alle = np.concatenate([expanded[live], ~new], axis=1)
        best = np.argpartition(alld + tie * alln, width - 1, axis=1)[:, :width]
        nodes[live] = np.take_along_axis(alln, best, 1)
        dist[live] = np.take_along_axis(alld, best, 1)
        expanded[live] = np.take_along_axis(alle, best, 1) | ~np.isfinite(dist[live])
    order = (dist + tie * nodes).argsort(axis=1, kind="stable")[:, :beam]
    dist = np.take_along_axis(dist, order, 1)
    return np.where(np.isfinite(dist), np.take_along_axis(nodes, order, 1), -1), dist


def robust_prune(x: np.ndarray, node: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node out of its candidates (-1: none)."""
    m = len(node)
    cand = np.where(cand == node[:, None], -1, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1  # each candidate once
    v = x[cand]
    d = ((v - x[node][:, None, :]) ** 2).sum(axis=2)
    d = np.where(cand >= 0, d, np.inf)
    order = d.argsort(axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    v = np.take_along_axis(v, order[:, :, None], 1)
    s = (v * v).sum(axis=2)
    pair = s[:, :, None] + s[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    out = np.full((m, degree), -1)
    alive = cand >= 0
    rows = np.arange(m)
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = cand[rows, pick][some]
        alive &= alpha * alpha * pair[rows, pick] > d
        alive[rows, pick] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 42, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry nodes) over the rows of ``x``: two passes, strict pruning, then relaxed by ``alpha``."""
    n = len(x)
    rng = np.random.default_rng([seed, n])
    x = x.astype(np.float32)
    sq = (x * x).sum(axis=1)
    graph = np.full((n, degree), -1)
    if n > 1:
        some = rng.integers(0, n - 1, (n, min(degree // 2, n - 1)))
        graph[:, :some.shape[1]] = some + (some >= np.arange(n)[:, None])
    middle = ((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin() if n else 0
    entry = np.unique(np.append(rng.choice(n, min(n, 8), replace=False), middle)) if n else np.zeros(0, int)
    for a in (1.0, alpha):
        for lo in range(0, n, block):
            node = np.arange(lo, min(lo + block, n))
            met, _ = beam_search(x, sq, graph, entry, x[node], beam)
            graph[node] = robust_prune(x, node, np.concatenate([met, graph[node]], axis=1), degree, a)
            # the new edges' other ends point back; full nodes are pruned anew
            src, dst = np.repeat(node, degree), graph[node].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            order = dst.argsort(kind="stable")
            src, dst = src[order], dst[order]
            ends, first, count = np.unique(dst, return_index=True, return_counts=True)
            back = np.full((len(ends), int(count.max()) if len(ends) else 0), -1)
            back[np.repeat(np.arange(len(ends)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
            for part in range(0, len(ends), block):
                e = ends[part:part + block]
                graph[e] = robust_prune(x, e, np.concatenate([graph[e], back[part:part + block]], axis=1), degree, a)
    return graph, entry


def _matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), dtype=np.float64) if len(series) else np.zeros((0, 0))


def _build_shard(pdf: pd.DataFrame, longest: float, degree: int, beam: int, alpha: float, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["low", "cls"], ignore_index=True)  # one order, whichever task runs this
    x = _matrix(pdf.v)
    pad = np.sqrt(np.maximum(longest * longest - (x * x).sum(axis=1), 0))
    graph, entry = build(np.column_stack([x, pad]), degree, beam, alpha, seed)
    return pdf[["shard", "cls", "low", "v"]].assign(node=np.arange(len(pdf)), links=list(graph), entry=np.isin(np.arange(len(pdf)), entry))


def _search_shard(index: pd.DataFrame, queries: pd.DataFrame, longest: float, k: int, beam: int) -> pd.DataFrame:
    empty = pd.DataFrame({"qcls": pd.Series(dtype="int64"), "cls": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
    if not len(index) or not len(queries):
        return empty
    index = index.sort_values("node", ignore_index=True)
    exact = _matrix(index.v)
    x = np.column_stack([exact, np.sqrt(np.maximum(longest * longest - (exact * exact).sum(axis=1), 0))]).astype(np.float32)
    graph, sq = np.array(index.links.tolist()), (x * x).sum(axis=1)
    entry, cls, low = np.flatnonzero(index.entry), index.cls.to_numpy(), index.low.to_numpy()
    q = _matrix(queries.v)
    qx = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
    out = []
    for lo in range(0, len(q), 256):
        met, _ = beam_search(x, sq, graph, entry, qx[lo:lo + 256], max(beam, k))
        row, at = np.nonzero(met >= 0)
        node = met[row, at]
        score = np.einsum("ij,ij->i", q[lo + row], exact[node])
        part = pd.DataFrame({"qcls": queries.qcls.to_numpy()[lo + row], "cls": cls[node], "low": low[node], "score": score})
        out.append(part.sort_values(["qcls", "score", "low"], ascending=[True, False, True]).groupby("qcls").head(k))
    return pd.concat([empty, *out], ignore_index=True)[list(empty.columns)]


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
            shard_rows: int = 5000, query_block: int = 4096, degree: int = DEGREE, build_beam: int = BUILD_BEAM,
            search_beam: int = SEARCH_BEAM, alpha: float = ALPHA, seed: int = 42) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product found for each
    row whose id is divisible by ``every``, over all rows but those of the query's own id.

    Equal vectors form one class, of which the graph holds one node and the answer the smallest
    ids (k + 1 at most can matter); of classes at one score a shard returns those of smallest id. All classes are indexed, in shards of about ``shard_rows``; every
    query block searches every shard; scores are inner products of the original vectors in
    double precision, ties go to the smaller id. Rows repeated with id and vector count once; an id
    with several vectors is several candidates, and as a query gets the k nearest of each vector
    together. Null ids, null, empty or zero vectors and those with null or non-finite components
    take no part; vectors are compared with those of the same length only. An empty table, or
    one without query rows, gives no rows.
    """
    spark = df.sparkSession
    ship_package(spark)
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & sound(v)).withColumn("cls", F.xxhash64("v"))
    slim = rows.select("id", "cls").distinct()
    members = reliable_checkpoint(slim.withColumn("_n", F.row_number().over(W.partitionBy("cls").orderBy("id"))).where(F.col("_n") <= k + 1).drop("_n"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, y: a + y * y))
    classes = reliable_checkpoint(rows.groupBy("cls").agg(F.first("v").alias("v"), F.min("id").alias("low")).select("cls", "low", "v", F.size("v").alias("dim"), norm.alias("norm")))
    asked = reliable_checkpoint(rows.where(F.col("id") % every == 0).select("id", F.col("cls").alias("qcls")).distinct())
    qvec = classes.join(asked.select(F.col("qcls").alias("cls")).distinct(), "cls", "left_semi").select(F.col("cls").alias("qcls"), F.col("v"), "dim")
    found = None
    for dim, n, longest in sorted(classes.groupBy("dim").agg(F.count("*"), F.max("norm")).collect()):
        shards = max(1, -(-n // shard_rows))
        own = classes.where(F.col("dim") == dim).select("cls", "low", "v", F.pmod(F.xxhash64("cls", F.lit(seed)), F.lit(shards)).alias("shard"))
        make = partial(_build_shard, longest=longest, degree=degree, beam=build_beam, alpha=alpha, seed=seed)
        index = reliable_checkpoint(own.groupBy("shard").applyInPandas(
            lambda pdf: make(pdf), "shard long, cls long, low long, v array<double>, node long, links array<long>, entry boolean"))
        ask = qvec.where(F.col("dim") == dim)
        blocks = max(1, -(-ask.count() // query_block))
        ask = ask.withColumn("block", F.pmod(F.xxhash64("qcls", F.lit(seed)), F.lit(blocks)))
        ask = ask.select("qcls", "v", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
        spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        look = partial(_search_shard, longest=longest, k=k + 1, beam=search_beam)
        part = spread.groupBy("shard", "block").cogroup(ask.groupBy("shard", "block")).applyInPandas(
            lambda a, b: look(a, b), "qcls long, cls long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "qcls long, cls long, score double")
    # a class's members tie; more than k + 1 classes can matter only through ties, so ranks are by score
    top = found.withColumn("_r", F.rank().over(W.partitionBy("qcls").orderBy(F.desc("score")))).where(F.col("_r") <= k + 1).drop("_r")
    hits = top.join(members, "cls").join(asked.withColumnRenamed("id", "query_id"), "qcls").where("id != query_id")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
