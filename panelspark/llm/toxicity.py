"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Chunks, WordCache, expand, map_rows, slices, text_bytes
from panelspark.llm.tokens import hash_words, spread, token_hashes

BITS = 18
_HITS: dict = {}


@dataclass
class ToxicModel:
    """A linear classifier over the presence of hashed tokens: bucket weights and a bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def _present(batch, bits) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct token buckets of each row, ordered by row."""
    flat, ptr = token_hashes(batch.column("text"))
    row = np.repeat(np.arange(batch.num_rows), np.diff(ptr))
    both = np.unique(row << bits | spread(flat, bits))
    return both >> bits, both & ((1 << bits) - 1)


def _frequencies(batches, bits):
    pos, all_ = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    for batch in slices(batches, "text"):
        row, bucket = _present(batch, bits)
        pos += np.bincount(bucket[np.asarray(batch.column("pos"))[row]], minlength=1 << bits)
        all_ += np.bincount(bucket[np.asarray(batch.column("unl"))[row]], minlength=1 << bits)
    some = np.flatnonzero(pos + all_)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(pos[some]), pa.array(all_[some])], names=["bucket", "pos", "unl"])


def _features(batches, buckets, bits):
    for batch in slices(batches, "text"):
        row, bucket = _present(batch, bits)
        at = np.minimum(np.searchsorted(buckets, bucket), max(len(buckets) - 1, 0))
        hit = buckets[at] == bucket if len(buckets) else np.zeros(len(bucket), bool)
        row, at = row[hit], at[hit]
        ptr = np.searchsorted(row, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(at.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("pos"), batch.column("unl"), lists], names=["pos", "unl", "features"])


class Ones:
    """A sparse matrix of zeros and ones, for products with vectors: the ones are at (row, col)."""

    def __init__(self, row: np.ndarray, col: np.ndarray, shape: tuple[int, int]):
        self.row, self.col, self.shape = row, col, shape

    @property
    def T(self) -> Ones:
        return Ones(self.col, self.row, self.shape[::-1])

    def __matmul__(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=v[self.col], minlength=self.shape[0])


def train_nnpu(xp: np.ndarray | Ones, xu: np.ndarray | Ones, prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic classifier under the non-negative risk prior*Rp(+) + max(0, Ru(-) - prior*Rp(-)).

    ``xp`` are confirmed positives, ``xu`` unlabelled rows. While the estimate of the negatives'
    risk is below zero (the positives are being learnt by heart), the step goes against it.
    """
    w, b = np.zeros(xp.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        fp, fu = xp @ w + b, xu @ w + b
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        neg = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp_pos, gp_neg, gu_neg = (sp - 1) / len(fp), sp / len(fp), su / len(fu)
        if neg >= 0:
            cp, cu = prior * gp_pos - prior * gp_neg, gu_neg
        else:
            cp, cu = prior * gp_neg, -gu_neg
        g = np.append(xp.T @ cp + xu.T @ cu + decay * w, cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        use: Column | None = None, max_positive: int = 10_000, max_unlabelled: int = 30_000,
        least_z: float = 5.0, least_positive: int = 5, bits: int = BITS) -> ToxicModel:
    """Train on at most ``max_positive`` rows labelled 1 and ``max_unlabelled`` rows taken without
    regard to labels (both the smallest hashes of the id), where ``use`` allows the id.

    The class prior is the share of 1 among the allowed labels. All token buckets are kept that
    occur in ``least_positive`` positives or more and are more frequent among them than among the
    unlabelled by ``least_z`` standard errors; only these columns of the bounded samples reach the
    driver, as sparse rows.
    """
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    ids = docs.where(F.col(id_col).isNotNull())
    if use is not None:
        marks, ids = marks.where(use), ids.where(use)
    marks = marks.groupBy(id_col).agg(F.max(label_col).alias("_y"))
    prior = marks.agg(F.avg("_y")).first()[0]
    prior = min(max(prior if prior is not None else 0.1, 1e-3), 0.9)
    order = (F.xxhash64(id_col), F.col(id_col))
    pos = marks.where("_y = 1").orderBy(*order).limit(max_positive).select(F.col(id_col).alias("id"), F.lit(True).alias("pos"))
    unl = ids.select(id_col).distinct().orderBy(*order).limit(max_unlabelled).select(F.col(id_col).alias("id"), F.lit(True).alias("unl"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(pos), "id", "left").join(F.broadcast(unl), "id", "left").where("pos or unl")
    rows = rows.select("text", F.coalesce("pos", F.lit(False)).alias("pos"), F.coalesce("unl", F.lit(False)).alias("unl"))
    n_pos, n_unl = rows.agg(F.sum(F.col("pos").cast("long")), F.sum(F.col("unl").cast("long"))).first()
    if not n_pos or not n_unl:
        return ToxicModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    freq = map_rows(rows, partial(_frequencies, bits=bits), "bucket long, pos long, unl long").groupBy("bucket").agg(
        F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))
    p, u = (F.col("pos") + 0.5) / (n_pos + 1.0), (F.col("unl") + 0.5) / (n_unl + 1.0)
    z = (p - u) / F.sqrt(u * (1 - u) * (1.0 / n_pos + 1.0 / n_unl))
    kept = freq.withColumn("z", z).where((F.col("z") >= least_z) & (F.col("pos") >= least_positive))
    buckets = np.sort(np.array([r.bucket for r in kept.select("bucket").collect()], dtype=np.int64))
    sample = map_rows(rows, partial(_features, buckets=buckets, bits=bits), "pos boolean, unl boolean, features array<int>").toPandas()
    row = np.repeat(np.arange(len(sample)), sample.features.map(len).to_numpy())
    col = np.concatenate([*sample.features, np.zeros(0, int)]).astype(int)

    def part(of):
        own = of[row]
        return Ones((np.cumsum(of) - 1)[row[own]], col[own], (int(of.sum()), len(buckets)))

    w, b = train_nnpu(part(sample.pos.to_numpy(bool)), part(sample.unl.to_numpy(bool)), prior)
    return ToxicModel(buckets, w, b, prior)


def _score(batches, model, bits):
    name = zlib.crc32(model.buckets.tobytes())
    if name not in _HITS:
        _HITS.clear()
        _HITS[name] = WordCache("toxicity")

    def hits(words):
        """Numbers of the model's buckets in each chunk; most have none."""
        coded = hash_words(words)
        lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        bucket = spread(np.frombuffer(b"".join(coded), "<u4"), bits)
        at = np.minimum(np.searchsorted(model.buckets, bucket), max(len(model.buckets) - 1, 0))
        hit = model.buckets[at] == bucket if len(model.buckets) else np.zeros(len(bucket), bool)
        out, ptr = [b""] * len(words), np.cumsum(lens) - lens
        for w in np.unique(np.repeat(np.arange(len(words)), lens)[hit]).tolist():
            own = slice(int(ptr[w]), int(ptr[w] + lens[w]))
            out[w] = at[own][hit[own]].astype("<u4").tobytes()
        return out

    for batch in slices(batches, "text"):
        chunks = Chunks(*text_bytes(batch.column("text")))
        coded = _HITS[name].fill([w.strip() for w in chunks.words], hits)
        flat, at = expand(np.frombuffer(b"".join(coded), "<u4"), np.array([len(c) // 4 for c in coded], dtype=np.int64), chunks.codes)
        row = np.repeat(np.arange(batch.num_rows), np.diff(at[chunks.ptr]))
        both = np.unique(row << bits | flat)
        f = model.bias + np.bincount(both >> bits, weights=model.weights[both & ((1 << bits) - 1)], minlength=batch.num_rows)
        score = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], names=["id", "score"])


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``(id, score)`` per row from the text alone; 0 to 1, higher: likelier toxic.

    Null, empty and wordless texts get the classifier's bias. Null and repeated ids and repeated
    rows are scored like others, an empty table gives no rows, and a model trained without
    positives scores the prior throughout.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, partial(_score, model=model, bits=bits), "id long, score double")
