"""Byte-level BPE by monoid tree reduction.

A piece (a match of the vocabulary's split pattern) is encoded by halving it down to short
leaves, encoding those by rank order, and joining neighbours up the tree. A join re-encodes a
window of tokens on both sides of the seam. A sequence of tokens is the encoding of its bytes
exactly if every two neighbours are the encoding of their joined bytes, so the window is
settled once its new tokens are compatible with the tokens left and right of it; otherwise it
doubles. Tokens outside a settled window provably stay. Decoding concatenates up a tree.
"""

from __future__ import annotations

import base64
import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Chunks, WordCache, expand, map_rows, slices, text_bytes

LEAF = 24  # bytes encoded without halving
NONE = 1 << 40  # rank of neighbours that do not merge
WINDOW = 2  # tokens re-encoded on each side of a seam at first


class Bpe:
    """Ranks of a ``.tiktoken`` file: ``encode`` text or pieces, ``decode`` ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = {v: k for k, v in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.compatible = WordCache("bpe", 1_000_000)
        self.words = WordCache("bpe")
        lens = np.zeros(max(self.bytes) + 1, np.int64)
        for i, b in self.bytes.items():
            lens[i] = len(b)
        self.lens = lens
        self.flat = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(len(lens))), np.uint8)

        cap = len(lens)
        merges = {}
        for whole, rank in self.ranks.items():
            for k in range(1, len(whole)):
                a, b = self.ranks.get(whole[:k]), self.ranks.get(whole[k:])
                if a is not None and b is not None:
                    merges[a * cap + b] = rank
        self.pairs = np.array(sorted(merges), dtype=np.int64)
        self.pair_rank = np.array([merges[k] for k in self.pairs.tolist()] + [NONE], dtype=np.int64)
        self.byte_rank = np.array([self.ranks[bytes([k])] for k in range(256)], dtype=np.int64)

    def leaves(self, pieces: list[bytes]) -> list[list[int]]:
        """``leaf`` for many pieces side by side: each round makes every piece's next merge."""
        tok = self.byte_rank[np.frombuffer(b"".join(pieces), np.uint8)]
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        owner = np.arange(len(pieces))
        out: list = [None] * len(pieces)
        while len(owner):
            start = np.cumsum(size) - size
            last = start + size - 1
            key = tok * len(self.lens)
            key[:-1] += tok[1:]
            at = np.searchsorted(self.pairs, key)
            found = self.pairs[np.minimum(at, len(self.pairs) - 1)] == key
            rank = np.where(found, self.pair_rank[at], NONE)
            rank[last] = NONE
            low = np.minimum.reduceat(rank, start)
            done = low == NONE
            if done.any():
                for i, a, b in zip(owner[done].tolist(), start[done].tolist(), (last[done] + 1).tolist()):
                    out[i] = tok[a:b].tolist()
                live = np.repeat(~done, size)
                tok, rank = tok[live], rank[live]
                owner, size, low = owner[~done], size[~done], low[~done]
                if not len(owner):
                    break
            piece = np.repeat(np.arange(len(owner)), size)
            hit = np.flatnonzero(rank == low[piece])
            hit = hit[np.diff(piece[hit], prepend=-1) > 0]  # the leftmost of each piece
            tok[hit] = low
            keep = np.ones(len(tok), bool)
            keep[hit + 1] = False
            tok = tok[keep]
            size = size - 1
        return out

    def leaf(self, piece: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        key = left, right
        known = self.compatible.get(key)
        if known is None:
            known = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
            self.compatible.fill([key], lambda _: [known])
        return known

    def merged(self, data: bytes) -> list[int]:
        """Encode the bytes of a window: short ones at once, longer ones as a tree of their own."""
        return self.leaf(data) if len(data) <= 8 * LEAF else self.piece(data)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours."""
        w = WINDOW
        while True:
            i, j = max(0, len(left) - w), min(len(right), w)
            if i == 0 and j == len(right):
                new = None
            else:
                data = b"".join(self.bytes[t] for t in left[i:]) + b"".join(self.bytes[t] for t in right[:j])
                new = self.leaf(data)
                if (i and not self.fits(left[i - 1], new[0])) or (j < len(right) and not self.fits(new[-1], right[j])):
                    w *= 2
                    continue
            if new is None:
                new = self.leaf(b"".join(self.bytes[t] for t in left + right))
            return left[:i] + new + right[j:]

    def halves(self, piece: bytes) -> list[bytes]:
        """The leaves of a piece: it is halved until they have at most ``LEAF`` bytes."""
        n = len(piece)
        count = 1 << (-(-n // LEAF) - 1).bit_length()
        edges = [n * k // count for k in range(count + 1)]
        return [piece[a:b] for a, b in zip(edges, edges[1:])]

    def reduce(self, row: list[list[int]]) -> list[int]:
        """Join encoded neighbours level by level up to the root."""
        while len(row) > 1:
            row = [self.join(row[k], row[k + 1]) for k in range(0, len(row), 2)]
        return row[0]

    def piece(self, piece: bytes) -> list[int]:
        """Encode one match of the pattern."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self.reduce([self.leaf(x) for x in self.halves(piece)])

    def split(self, word: str) -> list[str]:
        """Matches of the pattern; a word of letters alone is one match."""
        if (word[1:] if word[:1] == " " else word).isalpha():
            return [word]
        return [m[0] for m in self.pattern.finditer(word)]

    def encode(self, text: str) -> list[int]:
        return [t for p in self.split(text) for t in self.piece(p.encode())]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian, four bytes) of each word; the leaves of all words are merged side by side."""
        pieces = [[p.encode() for p in self.split(w.decode())] for w in words]
        new = list({p for row in pieces for p in row if p not in self.ranks})
        trees = [self.halves(p) for p in new]
        coded = iter(self.leaves([leaf for tree in trees for leaf in tree]))
        known = {p: self.reduce([next(coded) for _ in tree]) for p, tree in zip(new, trees)}
        ranks = self.ranks
        return [np.array([t for p in row for t in (known[p] if p in known else (ranks[p],))], dtype="<u4").tobytes()
                for row in pieces]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and each row's offsets. Cuts before white space are seams
        of the pattern, so every distinct chunk is encoded once."""
        chunks = Chunks(*text_bytes(texts), marks=True)
        coded = self.words.fill(chunks.words, self.encode_words)
        lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        ids, at = expand(np.frombuffer(b"".join(coded), "<u4"), lens, chunks.codes)
        return ids, at[chunks.ptr]

    def decode(self, ids: np.ndarray, leaf: int = 1 << 14) -> bytes:
        """Bytes of the ids: runs of ``leaf`` tokens, then neighbours joined level by level."""
        row = [expand(self.flat, self.lens, ids[k:k + leaf])[0].tobytes() for k in range(0, len(ids), leaf)] or [b""]
        while len(row) > 1:
            row = [b"".join(row[k:k + 2]) for k in range(0, len(row), 2)]
        return row[0]


_WORKER: dict = {}


def vocabulary(path: str, pattern: str) -> Bpe:
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = Bpe(path, pattern)
    return _WORKER[path, pattern]


def _encode(batches, path, pattern):
    bpe = vocabulary(path, pattern)
    for batch in slices(batches, "text"):
        ids, ptr = bpe.encode_column(batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "ids"])


def _decode(batches, path, pattern):
    bpe = vocabulary(path, pattern)
    for batch in batches:
        out = [bpe.decode(np.asarray(x or [], dtype=np.int64)) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "data"])


def _round_trip(batches, path, pattern):
    bpe = vocabulary(path, pattern)
    for batch in slices(batches, "text"):
        ids, ptr = bpe.encode_column(batch.column("text"))
        rows = [ids[a:b] for a, b in zip(ptr, ptr[1:])]
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array(np.diff(ptr)),
            pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
            pa.array([hashlib.sha256(bpe.decode(r)).hexdigest() for r in rows], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` per row; a null or empty text has no ids. Null and repeated ids,
    repeated rows and other columns make no difference; an empty table gives no rows."""
    return map_rows(_rows(df, id_col, text_col), partial(_encode, path=path, pattern=pattern), "id long, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``(id, data binary)``: the bytes that each row's ids stand for (null ids: no bytes)."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_rows(rows, partial(_decode, path=path, pattern=pattern), "id long, data binary")


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each row in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return map_rows(_rows(df, id_col, text_col), partial(_round_trip, path=path, pattern=pattern),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
