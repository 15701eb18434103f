"""SimHash fingerprints and near-duplicate classes by a binary trie self-join.

The join walks a binary trie of the fingerprints with itself: a pair of nodes of one depth
stands for all pairs of fingerprints below them, carries the number of bits in which their
paths differ, and is dropped once that number exceeds the budget. To deal the walk out over a
cluster, the trie is built once for each of ``max_bits + 1`` rotations of the bits: two
fingerprints within the budget agree on all of one of the ``max_bits + 1`` bit blocks, so in
the rotation that puts this block on top, both lie below the same node at the block's depth.
Tasks therefore start at equal top blocks (budget 0 above, the full budget below), and no link
is lost. A hot top block is divided over pair tasks by ``split_hot``.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import map_rows, reliable_checkpoint, slices, split_hot
from panelspark.llm.components import Forest, connected_components

SEED = 42
STEP = 1 << 16  # shingles counted at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, white space \x20 \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(starts), STEP):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[lo:lo + STEP], ends[lo:lo + STEP])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches, shingle):
    for batch in slices(batches, "text"):
        fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], names=["id", "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` per row, fp the fingerprint as a signed 64-bit integer."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, partial(_fingerprints, shingle=shingle), "id long, fp long")


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64, copy=False)).astype(np.int64)


def trie_links(keys: np.ndarray, top: np.ndarray, share: np.ndarray, cross: np.ndarray, depth: int, budget: int,
               frontier: int = 1 << 18) -> Forest:
    """Walk the trie of one sorted block of rotated fingerprints with itself and link what is near.

    ``keys`` (uint64, distinct within a task) are sorted by (``top``, key): ``top`` numbers the
    tasks, whose keys agree on the first ``depth`` bits. ``cross`` tells per key whether its task
    pairs two shares, then only pairs of different ``share`` count. Node pairs are held as index
    ranges; frontiers beyond ``frontier`` pairs are halved and walked one after the other, so
    memory stays bounded. Pairs of single keys are settled by their differing bits at once.
    """
    forest = Forest(len(keys))
    lo = np.flatnonzero(np.diff(top, prepend=-1)) if len(keys) else np.zeros(0, np.int64)
    hi = np.append(lo[1:], len(keys))
    many = hi - lo > 1
    stack = [(depth, lo[many], hi[many], lo[many], hi[many], np.zeros(int(many.sum()), np.int64))]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if not len(alo):
            continue
        if len(alo) > frontier:
            m = len(alo) // 2
            stack += [(d, *(v[m:] for v in (alo, ahi, blo, bhi, err))), (d, *(v[:m] for v in (alo, ahi, blo, bhi, err)))]
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        x, y = alo[single], blo[single]
        near = (x != y) & (popcount(keys[x] ^ keys[y]) <= budget) & (~cross[x] | (share[x] != share[y]))
        forest.link(x[near], y[near])
        alo, ahi, blo, bhi, err = (v[~single] for v in (alo, ahi, blo, bhi, err))
        if d == 64 or not len(alo):
            continue
        # children: the first index in each range whose next bit is 1
        bit = np.uint64(1) << np.uint64(63 - d)
        one = (keys & bit) != 0
        ones = np.concatenate([[0], np.cumsum(one)])
        amid = ahi - (ones[ahi] - ones[alo])
        bmid = bhi - (ones[bhi] - ones[blo])
        same = alo == blo
        kids = [(alo, amid, blo, bmid, err, None), (amid, ahi, bmid, bhi, err, None),
                (alo, amid, bmid, bhi, err + 1, None), (amid, ahi, blo, bmid, err + 1, ~same)]
        parts = []
        for p, q, r, s, e, only in kids:
            keep = (q > p) & (s > r) & (e <= budget)
            if only is not None:
                keep &= only
            keep &= ~((p == r) & (q - p == 1))  # a single key with itself
            parts.append([v[keep] for v in (p, q, r, s, e)])
        stack.append((d + 1, *(np.concatenate(v) for v in zip(*parts))))
    return forest


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    x = x.astype(np.uint64)
    return x if by == 0 else (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _walk(pdf: pd.DataFrame, width: int, budget: int) -> pa.RecordBatch:
    """Forest edges (member, smallest member of its tree) of whole tasks."""
    fp = pdf.fp.to_numpy().view(np.uint64)
    rot = pdf.rot.to_numpy()
    keys = np.zeros(len(fp), np.uint64)
    for r in np.unique(rot):
        keys[rot == r] = _rotate(fp[rot == r], int(r) * width)
    i, j, s = (pdf[c].to_numpy() for c in ("_i", "_j", "_s"))
    order = np.lexsort((keys, j, i, keys >> np.uint64(64 - width), rot))
    fp, rot, keys, i, j, s = (v[order] for v in (fp, rot, keys, i, j, s))
    new = np.ones(len(fp), bool)
    head = keys >> np.uint64(64 - width)
    new[1:] = (head[1:] != head[:-1]) | (rot[1:] != rot[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    forest = trie_links(keys, np.cumsum(new) - 1, s, i != j, width, budget)
    out = np.flatnonzero(forest.label != np.arange(len(fp)))
    return pa.RecordBatch.from_arrays([pa.array(fp[out].view(np.int64)), pa.array(fp[forest.label[out]].view(np.int64))], names=["a", "b"])


def _walk_tasks(batches, width, budget, block=1 << 18):
    """Whole tasks, gathered from the sorted partition until a block is full."""
    held = None
    for batch in batches:
        pdf = batch.to_pandas()
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if len(held) < block:
            continue
        task = ["rot", "head", "_i", "_j"]
        whole = (held[task] != held[task].iloc[-1]).any(axis=1).to_numpy()  # the last task may go on
        if whole.any():
            yield _walk(held[whole], width, budget)
            held = held[~whole].reset_index(drop=True)
    if held is not None and len(held):
        yield _walk(held, width, budget)


def hamming_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Spanning edges ``(a, b)`` over the distinct ``fp`` values: two values are connected by
    them exactly if a chain of steps of at most ``max_bits`` differing bits joins them."""
    blocks = max_bits + 1
    width = 64 // blocks
    rots = F.explode(F.array(*[F.struct(F.lit(r).alias("rot"), F.shiftrightunsigned(
        F.expr(f"(shiftleft(fp, {r * width}) | shiftrightunsigned(fp, {64 - r * width}))") if r else F.col("fp"),
        64 - width).alias("head")) for r in range(blocks)]))
    rows = fps.select("fp", rots.alias("x")).select("fp", "x.rot", "x.head")
    tasks = split_hot(rows, ["rot", "head"], F.xxhash64("fp"))
    tasks = tasks.select("rot", "head", "_i", "_j", "_s", "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = tasks.repartition(parts, "rot", "head", "_i", "_j").sortWithinPartitions("rot", "head", "_i", "_j")
    return map_rows(tasks, partial(_walk_tasks, width=width, budget=max_bits), "a long, b long")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 3) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id, kept``.

    Fingerprints at most ``max_bits`` bits apart are linked; ``component_id`` is the smallest id
    reachable over links. Rows of one fingerprint are one node, so copies make no pairs.
    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null
    id keep their class's smallest id (null if it has none) and are never ``kept``; repeated
    ids each give a row. Other columns of ``df`` are not read. An empty table gives no rows.
    """
    docs = reliable_checkpoint(fingerprints(df, id_col, text_col, shingle))
    nodes = reliable_checkpoint(docs.groupBy("fp").agg(F.min("id").alias("low")))
    roots = connected_components(hamming_links(nodes.select("fp"), max_bits))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = nodes.join(lows, "root").select("fp", "component_id")
    return docs.join(classes, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each class of ``simhash_dedup``, with all its columns: the first by id, then by a hash of its columns.

    Rows with a null id stand after all others. Each row belongs to the class of its own text, so rows of one id with
    unlike texts are kept or dropped apart; of rows equal in all columns one stays.
    """
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), df[id_col].cast("long").alias("_id"), mark.alias("_mark"), df[text_col].alias("_text"))
    docs = reliable_checkpoint(fingerprints(rows, "_mark", "_text", shingle).distinct().join(
        rows.select(F.col("_mark").alias("id"), "_id").distinct(), "id"))
    roots = connected_components(hamming_links(docs.select("fp").distinct(), max_bits)).withColumnRenamed("node", "fp")
    first = docs.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "id")).alias("first"))
    return rows.select("_mark", "_row").join(first.select(F.col("first.id").alias("_mark")), "_mark", "left_semi").dropDuplicates(["_mark"]).select("_row.*")
