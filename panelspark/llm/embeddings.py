"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosine checks.

On unit vectors, cosine c is Euclidean distance sqrt(2 - 2c). A table hashes a vector by ``k``
random projections, shifted and cut into cells of width ``w``; near vectors share all k cells of
some table with high probability. Vectors that share a bucket are compared exactly.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import map_rows, reliable_checkpoint, split_hot
from panelspark.llm.components import Forest, connected_components


def collision(distance: float, width: float) -> float:
    """Probability that two vectors at a distance fall into one cell of a Gaussian projection."""
    t = width / distance
    return 1 - math.erfc(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def tables_for(rows: int, cosine: float, recall: float) -> tuple[int, int, float]:
    """(projections per table, tables, cell width): unrelated vectors (at right angles) share a
    bucket less than once per row and table; pairs at the threshold are found with ``recall``."""
    near = math.sqrt(2 - 2 * cosine)
    width = 4 * near
    k = max(2, math.ceil(math.log(max(rows, 2)) / -math.log(collision(math.sqrt(2), width))) + 2)
    return k, math.ceil(math.log(1 - recall) / math.log(1 - collision(near, width) ** k)), width


class Hasher:
    """The projections of all tables, made from a seed: the same in every task."""

    def __init__(self, dim: int, k: int, tables: int, width: float, seed: int = 42):
        rng = np.random.default_rng([seed, dim, k, tables])
        self.dim, self.k, self.tables, self.width = dim, k, tables, width
        self.a = rng.standard_normal((dim, tables * k))
        self.b = rng.uniform(0, width, tables * k)
        self.mix = rng.integers(1, 1 << 62, k, dtype=np.int64) | 1

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per vector and table."""
        cells = np.floor((unit @ self.a + self.b) / self.width).astype(np.int64)
        return (cells.reshape(len(unit), self.tables, self.k) * self.mix).sum(axis=2)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, of one length, as float64 rows."""
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    x = np.asarray(flat, dtype=np.float64)
    return x.reshape(len(column), -1) if len(column) else x.reshape(0, 0)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _hash(batches, hasher):
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            h = hasher.buckets(unit_rows(matrix(part.column("v"))))
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.asarray(part.column("cls")), hasher.tables)),
                pa.array(np.tile(np.arange(hasher.tables, dtype=np.int32), n)), pa.array(h.reshape(-1))], names=["cls", "t", "bucket"])


def _compare(x, hasher, table, size, share, cross, cosine, links, forest, block=1024):
    """Links inside one task's rows. A pair counts in the first table in which it shares a bucket;
    only rows of near pairs are hashed for this."""
    n = len(x)
    buckets, hashed = np.empty((n, table), np.int64), np.zeros(n, bool)
    few = max(1, (1 << 22) // max(table, 1))
    for lo in range(0, n, block):
        for lo2 in range(lo, n, block):
            near = x[lo:lo + block] @ x[lo2:lo2 + block].T >= cosine
            i, j = np.nonzero(near)
            i, j = i + lo, j + lo2
            ok = i < j
            if cross:
                ok &= share[i] != share[j]
            i, j = i[ok], j[ok]
            if table and len(i):
                new = np.unique(np.concatenate([i, j]))
                new = new[~hashed[new]]
                for k in range(0, len(new), 1024):
                    buckets[new[k:k + 1024]] = hasher.buckets(x[new[k:k + 1024]])[:, :table]
                hashed[new] = True
                first = np.concatenate([~(buckets[i[k:k + few]] == buckets[j[k:k + few]]).any(axis=1) for k in range(0, len(i), few)])
                i, j = i[first], j[first]
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            forest.link(i, j)


def _tasks(batches, hasher, cosine):
    """Rows sorted by task; whole tasks are compared, their counts and forest edges given out."""
    def done(rows):
        out = []
        table = pa.Table.from_batches(rows)
        key = [np.asarray(table.column(c)) for c in ("t", "bucket", "_i", "_j")]
        new = np.ones(len(table), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
        edges = [*np.flatnonzero(new).tolist(), len(table)]
        x = unit_rows(matrix(table.column("v").combine_chunks()))
        cls, size, share = (np.asarray(table.column(c)) for c in ("cls", "size", "_s"))
        for a, b in zip(edges, edges[1:]):
            if b - a < 2:
                continue
            links, forest = np.zeros(b - a, np.int64), Forest(b - a)
            _compare(x[a:b], hasher, int(key[0][a]), size[a:b], share[a:b], bool(key[2][a] != key[3][a]), cosine, links, forest)
            some = np.flatnonzero(links)
            out.append((cls[a:b][some], cls[a:b][forest.label[some]], links[some]))
        cols = [np.concatenate(v) if out else np.zeros(0, np.int64) for v in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["cls", "root", "links"])

    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < 1 << 15:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = np.ones(len(table), bool)
        for c in ("t", "bucket", "_i", "_j"):
            col = np.asarray(table.column(c))
            last &= col == col[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0  # the last task may go on
        if cut:
            yield done(table.slice(0, cut).to_batches())
            held = table.slice(cut).to_batches()
            count = len(table) - cut
    if count:
        yield done(held)


def sound(v: Column) -> Column:
    """Whether a vector is neither null, empty nor zero and has only finite components."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def embedding_dedup(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95,
                    recall: float = 0.9999, seed: int = 42) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Equal vectors become one class first, so copies make no pairs; classes are hashed, buckets
    of one class dropped, and classes of a bucket compared exactly in double precision. A pair
    found in several tables counts once, in the first. A bucket with many classes is divided
    over pair tasks. ``n_links`` is the number of other rows found with a cosine of at least
    ``cosine`` (equal vectors among them); a pair at the threshold is found with probability
    ``recall``, closer ones with a higher one. Vectors of different lengths do not link.

    Null, empty and zero vectors and those with null or non-finite components link with nothing
    and are their own component. A row with a null id takes part, but is never ``kept``. Repeated
    rows are rows of their own that link with each other; an empty table gives no rows.
    """
    from pyspark.sql import types as T

    # single-precision components stay as they are while they move; tasks compute in double precision
    kind = df.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vector = F.col(vector_col).cast("array<float>" if single else "array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"))
    rows = rows.withColumn("cls", F.when(sound(F.col("v")), F.xxhash64("v")))
    classes = reliable_checkpoint(rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.first("v").alias("v"), F.min("vec_id").alias("low"), F.count("*").alias("size")))
    edges, counts = None, None
    dims = [r[0] for r in classes.select(F.size("v").alias("d")).distinct().collect()]
    for dim in sorted(dims):
        own = classes.where(F.size("v") == dim)
        n = own.count()
        k, tables, width = tables_for(n, cosine, recall)
        hasher = Hasher(dim, k, tables, width, seed)
        keys = reliable_checkpoint(map_rows(own.select("cls", "v"), partial(_hash, hasher=hasher), "cls long, t int, bucket long"))
        shared = keys.groupBy("t", "bucket").count().where("count > 1").select("t", "bucket")
        # hot buckets are found and divided by ids alone; a vector joins its tasks just before they are dealt out
        members = keys.join(shared, ["t", "bucket"])
        tasks = split_hot(reliable_checkpoint(members), ["t", "bucket"], F.xxhash64("cls"))
        tasks = tasks.join(own.select("cls", "v", "size"), "cls").select("t", "bucket", "_i", "_j", "_s", "cls", "size", "v")
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = tasks.repartition(parts, "t", "bucket", "_i", "_j").sortWithinPartitions("t", "bucket", "_i", "_j")
        found = reliable_checkpoint(map_rows(tasks, partial(_tasks, hasher=hasher, cosine=cosine), "cls long, root long, links long"))
        e = found.select(F.col("cls").alias("a"), F.col("root").alias("b"))
        c = found.select("cls", "links")
        edges, counts = (e, c) if edges is None else (edges.unionByName(e), counts.unionByName(c))
    if edges is None:
        spark = df.sparkSession
        edges = spark.createDataFrame([], T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
        counts = spark.createDataFrame([], T.StructType([T.StructField("cls", T.LongType()), T.StructField("links", T.LongType())]))
    roots = connected_components(edges).withColumnRenamed("node", "cls")
    near = classes.join(counts.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left").join(roots, "cls", "left").select(
        "cls", "low", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    near = reliable_checkpoint(near)
    lows = near.groupBy("root").agg(F.min("low").alias("component_id"))
    near = near.join(lows, "root").select("cls", "n_links", "component_id")
    return rows.select("vec_id", "cls").join(near, "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
