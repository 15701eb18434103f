"""Concatenate-and-cut packing: token totals per partition, prefix sums over them, fixed windows."""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.llm.common import Chunks, WordCache, expand, map_rows, reliable_checkpoint, slices, text_bytes

_WORKER: dict = {}


def _vocabulary(path: str):
    """(tokenizer, word cache) of this Python worker."""
    if path not in _WORKER:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True  # their strings in a text are ordinary text
        _WORKER[path] = tok, WordCache("packing")
    return _WORKER[path]


MARK = "\x01"  # parts words in a joined line


def _encode_words(tok, words: list[bytes], line: int = 2000) -> list[bytes]:
    """Ids of each word. Plain words are encoded as lines of many, parted by a control character
    that is a token of its own; this spares the library's cost per call."""
    mark = tok.encode(MARK, add_special_tokens=False).ids
    plain = [i for i, w in enumerate(words) if len(mark) == 1 and w.isalnum()]
    out: list = [None] * len(words)
    lines = [plain[k:k + line] for k in range(0, len(plain), line)]
    texts = [f" {MARK} ".join(words[i].decode() for i in run) for run in lines]
    for run, e in zip(lines, tok.encode_batch_fast(texts, add_special_tokens=False)):
        ids = np.array(e.ids, dtype="<u4")
        at = np.flatnonzero(ids == mark[0])
        for i, a, b in zip(run, [0, *(at + 1).tolist()], [*at.tolist(), len(ids)]):
            out[i] = ids[a:b].tobytes()
    rest = [i for i, x in enumerate(out) if x is None]
    for i, e in zip(rest, tok.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False)):
        out[i] = np.array(e.ids, dtype="<u4").tobytes()
    return out


def _keys(words: list[bytes]) -> list[bytes]:
    """The vocabulary drops white space and lower-cases (only ASCII words are lowered here:
    other characters may compose before they are lowered)."""
    return [w.lower() if w.isascii() else w for w in map(bytes.strip, words)]


def _tokenise(batches, path, end_id):
    """Rows of ids: the vocabulary never merges across white space, so each distinct word is encoded once."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from pyspark import TaskContext

    tok, cache = _vocabulary(path)
    part, before = TaskContext.get().partitionId(), 0
    for batch in slices(batches, "text"):
        chunks = Chunks(*text_bytes(batch.column("text")), marks=True)
        coded = cache.fill(_keys(chunks.words), partial(_encode_words, tok))
        lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        ids, at = expand(np.frombuffer(b"".join(coded), "<u4"), lens, chunks.codes)
        ptr = at[chunks.ptr]
        rows = [np.append(ids[a:b], np.uint32(end_id)) for a, b in zip(ptr, ptr[1:])]
        n = np.diff(ptr) + 1
        first = before + np.cumsum(n) - n
        before += int(n.sum())
        small = [r.astype("<u2").tobytes() if not len(r) or r.max() < 1 << 16 else r.astype("<u4").tobytes() for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.full(len(n), part)), pa.array(first), pa.array(n), pa.array(small, pa.binary())],
            names=["id", "part", "first", "n", "ids"])


def _cut(batches, window):
    for batch in slices(batches, "ids"):
        cols = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        for i, first, n, raw in zip(*(batch.column(c).to_pylist() for c in ("id", "first", "n", "ids"))):
            ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
            start = 0
            while start < n:
                at = first + start
                length = min(n - start, window - at % window)
                for k, v in zip(cols, (i, start, length, zlib.crc32(ids[start:start + length].tobytes()), n, at // window, at % window)):
                    cols[k].append(v)
                start += length
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in cols.values()], names=list(cols))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenise(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """``(id, part, first, n, ids)``: a row's ids with ``end_id`` last (little-endian, two bytes
    each where all fit, else four), its partition, and the partition's ids before it."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, partial(_tokenise, path=vocabulary, end_id=end_id), "id long, part long, first long, n long, ids binary")


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096,
         end_id: int = 2) -> DataFrame:
    """Pack all rows of ``df`` into windows of ``window`` ids: one row per piece of a document.

    First pass: each partition tokenises its rows and numbers their ids from 0; the rows go to a
    reliable checkpoint, so later steps see one fixed order. The partitions' totals (a row per
    partition) are summed up in order and sent to all tasks. Second pass: partition total plus
    offset in the partition is a document's place in the endless line of ids, which is cut at
    every multiple of ``window``. Only the last window is not full; no id is dropped or repeated.

    Null texts count as empty: a single piece that holds ``end_id``. Repeated rows are packed each
    for itself, null ids are kept, an empty table gives no rows, other columns are not read.
    """
    rows = reliable_checkpoint(tokenise(df, vocabulary, id_col, text_col, end_id))
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    line = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    base = totals.select("part", F.coalesce(F.sum("total").over(line), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(base), "part").select("id", (F.col("first") + F.col("base")).alias("first"), "n", "ids")
    return map_rows(placed, partial(_cut, window=window), PIECES)
