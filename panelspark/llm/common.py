"""Helpers shared by the operators: table access, Arrow text slices, hot-key splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import reliable_checkpoint, ship_package  # noqa: F401

#: a task works through its rows in slices of about this many bytes of text
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def map_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the Python workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of whole rows of about ``limit`` bytes of ``column``.

    A row longer than the limit makes a slice of its own; no text is cut.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        which = (np.cumsum(sizes) - sizes) // limit
        edges = np.flatnonzero(np.diff(which, prepend=-1)).tolist() + [batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            yield batch.slice(lo, hi - lo)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and the rows' offsets into them (null: empty)."""
    texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, data = texts.buffers()
    offs = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
MARK = np.zeros(256, bool)  # other visible ASCII characters
MARK[33:127] = ~LETTER[33:127]


class Chunks:
    """Texts cut before each run of ASCII white space, each distinct chunk held once.

    A chunk is white space followed by a word (or white space alone at a text's end), so the
    chunks of a text joined give the text back. With ``marks``, they are also cut between an ASCII
    letter and a following ASCII digit or sign. ``codes`` numbers the chunks into ``words``
    (bytes); text i owns ``codes[ptr[i]:ptr[i + 1]]``. A cut is left out where the character
    before it may be white space beyond ASCII, so no run of white space is ever divided.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, marks: bool = False):
        n = len(data)
        space = SPACE[data]
        cut = np.zeros(n + 1, bool)
        if n > 1:
            cut[1:n] = space[1:] & ~space[:-1]
            odd = (data[:-1] >= 0x1C) & (data[:-1] <= 0x1F)  # control characters some engines call space
            odd[1:] |= (data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0))
            if n > 3:
                lead, mid = data[:-3], data[1:-2]
                odd[2:] |= ((lead >= 0xE1) & (lead <= 0xE3)) & ((mid == 0x80) | (mid == 0x81) | (mid == 0x9A))
            cut[1:n] &= ~odd
            if marks:
                cut[1:n] |= LETTER[data[:-1]] & MARK[data[1:]]
        cut[offs] = True
        cut[n] = False
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, n).astype(np.int32 if n < 1 << 31 else np.int64)
        kind = pa.binary() if n < 1 << 31 else pa.large_binary()
        pieces = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        self.words: list[bytes] = coded.dictionary.to_pylist()
        self.codes = np.asarray(coded.indices)
        self.ptr = np.searchsorted(starts, offs)


def expand(flat: np.ndarray, lens: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lay out the values of each code one after the other: (values, offsets of each code's run)."""
    at = np.cumsum(lens) - lens
    n = lens[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    idx = np.repeat(at[codes] - (ends - n), n) + np.arange(total)
    return flat[idx], np.concatenate([[0], ends]).astype(np.int64)


class WordCache(dict):
    """Results by word for one Python worker; emptied when it holds ``limit`` words.

    Workers are reused from stage to stage: the first use by another ``owner`` empties the caches
    of all others, so a worker holds the words of one operator at most.
    """

    held: list["WordCache"] = []
    current = ""

    def __init__(self, owner: str, limit: int = 500_000):
        super().__init__()
        self.owner, self.limit = owner, limit
        WordCache.held.append(self)

    def fill(self, words: list, compute: Callable[[list], list]) -> list:
        if WordCache.current != self.owner:
            WordCache.current = self.owner
            for other in WordCache.held:
                if other.owner != self.owner:
                    other.clear()
        new = list(dict.fromkeys(w for w in words if w not in self))
        if len(self) + len(new) > self.limit:
            self.clear()
            new = list(dict.fromkeys(words))
        self.update(zip(new, compute(new)))
        return [self[w] for w in words]


def text_of_row(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of one struct column ``kept`` with its text field beside it as ``text`` (not copied)."""
    for batch in batches:
        kept = batch.column("kept")
        yield pa.RecordBatch.from_arrays([kept, pc.struct_field(kept, column)], names=["kept", "text"])


def split_hot(df: DataFrame, keys: list[str], row_id: Column, least: int = 1024) -> DataFrame:
    """Deal the rows of each key to pair tasks ``(keys, _i, _j)`` so that no task holds a hot key.

    A key of at most B rows stays whole, as task (0, 0). A larger one gets k = ceil(n / B)
    shares by ``row_id``; a row of share s goes to the k tasks (min(s, j), max(s, j)), so every
    pair of rows meets: within a share in task (s, s), across two shares in one task only.
    ``_s`` is the row's share. B is half a shuffle partition's fair share of the rows (``least``
    at the smallest), so at most twice as many keys as partitions are hot: the broadcast table
    of hot keys is bounded by the partition count, whatever the data.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    share = max(least, -(-total // (2 * parts)))
    hot = df.groupBy(*keys).count().where(F.col("count") > share)
    hot = hot.select(*keys, F.ceil(F.col("count") / share).cast("int").alias("_k"))
    out = df.join(F.broadcast(hot), keys, "left").withColumn("_k", F.coalesce("_k", F.lit(1)))
    out = out.withColumn("_s", F.when(F.col("_k") > 1, F.pmod(row_id, F.col("_k"))).otherwise(0).cast("int"))
    out = out.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return out.withColumns({"_i": F.least("_s", "_t"), "_j": F.greatest("_s", "_t")}).drop("_k", "_t")
