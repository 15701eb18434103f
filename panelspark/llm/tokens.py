"""Hashed word and sign tokens of text columns, computed once per distinct chunk."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa

from panelspark.llm.common import Chunks, WordCache, expand, text_bytes

TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE = WordCache("tokens")


def hash_words(words: list[bytes]) -> list[bytes]:
    """crc32 (little-endian, four bytes) of the tokens of each chunk."""
    return [np.array([zlib.crc32(t.encode()) for t in TOKEN.findall(w.decode("utf-8", "replace").lower())], dtype="<u4").tobytes()
            for w in words]


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of each lower-cased token (a run of word characters or of signs), rows end to end,
    and each row's offsets."""
    chunks = Chunks(*text_bytes(texts))
    coded = _CACHE.fill([w.strip() for w in chunks.words], hash_words)
    lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
    flat, at = expand(np.frombuffer(b"".join(coded), "<u4"), lens, chunks.codes)
    return flat, at[chunks.ptr]


def spread(h: np.ndarray, bits: int) -> np.ndarray:
    """Bucket numbers of 32-bit hashes (multiply and shift)."""
    return ((h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def ngrams(flat: np.ndarray, ptr: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the rows' unigrams and bigrams, and each row's offsets into them."""
    n = np.diff(ptr)
    pairs = np.maximum(n - 1, 0)
    ends = np.cumsum(n + pairs)
    start = ends - (n + pairs)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(flat)) - ptr[:-1][row] + start[row]
    out[place] = spread(flat, bits)
    first = np.flatnonzero(row[1:] == row[:-1])  # a bigram never spans two rows
    both = flat[first].astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD) + flat[first + 1] + np.uint64(1)
    out[place[first] + n[row[first]]] = (both * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    return out, np.concatenate([[0], ends]).astype(np.int64)


def row_sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums (over the first axis) of each row's run of values; 0 for an empty run."""
    out = np.zeros((len(ptr) - 1, *values.shape[1:]))
    some = np.flatnonzero(np.diff(ptr))
    if len(some):
        out[some] = np.add.reduceat(values[ptr[0]:ptr[-1]], ptr[:-1][some] - ptr[0], axis=0, dtype=np.float64)
    return out
