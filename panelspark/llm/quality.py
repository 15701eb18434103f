"""Importance resampling of documents: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import fold, map_rows, reliable_checkpoint, slices, text_of_row
from panelspark.llm.tokens import ngrams, row_sums, token_hashes

BITS = 16


@dataclass
class RatioModel:
    """``weights[b]``: log p_target(b) - log p_raw(b) of bucket b; ``prior``: share of target text."""

    weights: np.ndarray
    prior: float


def _count(batches, bits):
    raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    for batch in slices(batches, "text"):
        grams, ptr = ngrams(*token_hashes(batch.column("text")), bits)
        raw += np.bincount(grams, minlength=1 << bits)
        chosen = np.repeat(np.asarray(batch.column("target")), np.diff(ptr))
        target += np.bincount(grams[chosen], minlength=1 << bits)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        use: Column | None = None, max_target: int = 20_000, bits: int = BITS, smooth: float = 500.0) -> RatioModel:
    """Fit both generative models.

    The raw model counts the n-grams of all rows of ``docs``. The target model counts those of
    rows labelled 1, at most ``max_target`` of them (the smallest hashes of the id), where ``use``
    allows the row's label. Counts are added up per partition before the shuffle; 2^bits sums
    reach the driver, whatever the input. Each bucket gets ``smooth`` added in both models, on
    the scale of the target's total, so rare buckets weigh next to nothing.
    """
    allowed = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if use is not None:
        allowed = allowed.where(use)
    marks = allowed.groupBy(id_col).agg(F.max(label_col).alias("_y"))
    prior = marks.agg(F.avg("_y")).first()[0]
    chosen = marks.where("_y = 1").orderBy(F.xxhash64(id_col), id_col).limit(max_target).select(F.col(id_col).alias("id"), F.lit(True).alias("target"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    sums = map_rows(rows, partial(_count, bits=bits), "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[sums.bucket], target[sums.bucket] = sums.raw, sums.target
    weights = np.log(target + smooth) - np.log(raw * (target.sum() / max(raw.sum(), 1)) + smooth)
    return RatioModel(weights.astype(np.float32), min(max(prior if prior is not None else 0.5, 1e-3), 1 - 1e-3))


def _score(batches, weights, bits, row_text=None):
    for batch in slices(text_of_row(batches, row_text) if row_text else batches, "text"):
        flat, at = token_hashes(batch.column("text"))
        grams, ptr = ngrams(flat, at, bits)
        ratio, n = row_sums(weights[grams], ptr), np.diff(at)
        noise = np.asarray(batch.column("kept").field("_noise") if row_text else batch.column("noise")).view(np.uint64)
        uniform = ((noise >> np.uint64(11)) + 0.5) * 2.0 ** -53
        key = ratio - np.log(-np.log(uniform))
        place = np.where(n > 0, np.round(key * 2.0 ** 30), np.iinfo(np.int64).min).astype(np.int64)
        keep = [c for c in batch.schema.names if c not in ("text", "noise")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n), pa.array(ratio), pa.array(key), pa.array(place)],
                                         names=[*keep, "n_tokens", "log_ratio", "key", "place"])


def _scored(docs: DataFrame, model: RatioModel, id_col: str, text_col: str, seed: int, whole: bool = False) -> DataFrame:
    """``kept, n_tokens, log_ratio, key, place``; place orders the keys as whole multiples of 2^-30.
    ``kept`` is the id or, with ``whole``, a struct of all columns and the hash behind the noise."""
    text = F.col(text_col).cast("string")
    noise = F.xxhash64(F.col(id_col).cast("long"), text, F.lit(seed))
    if whole:
        rows = docs.select(F.struct(*[docs[c] for c in docs.columns], noise.alias("_noise")).alias("kept"))
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("kept"), text.alias("text"), noise.alias("noise"))
    score = partial(_score, weights=model.weights, bits=int(math.log2(len(model.weights))), row_text=text_col if whole else None)
    return map_rows(rows, score, f"kept {rows.schema['kept'].dataType.simpleString()}, n_tokens long, log_ratio double, key double, place long")


def _kth_largest(df: DataFrame, col: str, k: int) -> int:
    """The exact k-th largest value of a long column: four rounds over 16 bits each, the counts
    of one round's at most 65,536 buckets reach the driver."""
    x = F.col(col).bitwiseXOR(F.expr("shiftleft(1L, 63)"))  # unsigned order
    prefix = 0
    for shift in (48, 32, 16, 0):
        rows = df if shift == 48 else df.where(F.shiftrightunsigned(x, shift + 16) == F.lit(prefix))
        digit = F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(0xFFFF))
        for d, n in sorted(rows.groupBy(digit.alias("d")).count().collect(), reverse=True):
            if k <= n:
                prefix = prefix << 16 | d
                break
            k -= n
    return prefix - (1 << 63)


def _threshold(scored: DataFrame, model: RatioModel, k: int | None) -> int | None:
    """The place of the k-th largest key; None if nothing is to be drawn."""
    able = scored.where("n_tokens > 0")
    odds = math.log(model.prior / (1 - model.prior))
    n, likely = able.agg(F.count("*"), F.sum((F.col("log_ratio") + F.lit(odds) >= 0).cast("long"))).first()
    k = min(n, (likely or 0) if k is None else k)
    return _kth_largest(able, "place", k) if k > 0 else None


def resample(docs: DataFrame, model: RatioModel, id_col: str = "doc_id", text_col: str = "text", k: int | None = None,
             seed: int = 42) -> DataFrame:
    """Score every row and draw ``k`` of them without replacement in proportion to their weights.

    ``id, n_tokens, log_ratio, key, selected``: ``log_ratio`` is log p_target - log p_raw of the
    whole text; ``key`` adds Gumbel noise hashed from (id, text, ``seed``), so a run can be
    repeated and a lost task gives the same rows again; the k largest keys are ``selected``
    (rows tied with the k-th, such as repeated rows, all are). By default k is the number of
    rows that the two models with their prior find likelier target than not.

    A null or empty text, or one without a word or sign, has log_ratio 0 and is never selected.
    Null ids and repeated rows are scored like others. An empty table gives no rows; other
    columns are not read. The exact k-th key is found by counting, so nothing is sorted or
    collected.
    """
    scored = reliable_checkpoint(_scored(docs, model, id_col, text_col, seed))
    least = _threshold(scored, model, k)
    chosen = F.lit(False) if least is None else (F.col("n_tokens") > 0) & (F.col("place") >= F.lit(least))
    return scored.select(F.col("kept").alias("id"), "n_tokens", "log_ratio", "key", chosen.alias("selected"))


def keep_selected(docs: DataFrame, model: RatioModel, id_col: str = "doc_id", text_col: str = "text", k: int | None = None,
                  seed: int = 42) -> DataFrame:
    """The rows that ``resample`` selects, with all their columns: scored twice, so that no text is
    shuffled (the first time for the threshold, the second to let rows pass)."""
    least = _threshold(reliable_checkpoint(_scored(docs, model, id_col, text_col, seed)), model, k)
    if least is None:
        return docs.limit(0)
    again = _scored(docs, model, id_col, text_col, seed, whole=True)
    return again.where((F.col("n_tokens") > 0) & (F.col("place") >= F.lit(least))).select("kept.*").drop("_noise")


def fit_on_labels(docs: DataFrame, labels: DataFrame, **kw) -> RatioModel:
    """``fit`` on labels of rows whose crc32 of the id as text modulo 5 is not 0; the others stay
    for a test of the model."""
    return fit(docs, labels, use=fold("doc_id", 5) != 0, **kw)
