"""Byte-level BPE by content-defined chunk reuse.

A rolling hash over the last bytes cuts texts where their content says so, hence a passage that
stands in many documents gives the same chunks in all of them. A worker encodes each distinct chunk
once. A chunk on its own settles the tokens between its first and its last fixed point; the
tokens at its edges depend on the neighbours. So every join of chunks is repaired: the bytes around the seam are
encoded anew in a window that grows to both sides, over whole chunks if need be, until it meets a fixed
point, from where on the old tokens agree exactly with those of the whole text.

A fixed point is a place between a character that is not white space and ASCII white space. Every match of
the pre-tokeniser is a contraction, a run of letters, digits or signs behind at most one blank, or a run of
white space; none holds white space behind another character, and added tokens hold none. No token of any
text spans a fixed point, and what stands on one side of it does not change the tokens of the other.
"""

from __future__ import annotations

import hashlib
import os
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import SPACE, WordCache, expand, map_rows, slices, text_bytes

#: bytes that the rolling hash looks back on (a power of two)
LOOKBACK = 16
#: a cut falls on one byte in 2 ** CUT_BITS (measured: shorter chunks recur more often and cost least)
CUT_BITS = 2
#: longer chunks and windows are encoded without being kept for reuse
KEEP_BYTES = 1024
#: short strings are encoded in lines of about this many bytes
LINE_BYTES = 1 << 16

BLANK = np.zeros(256, bool)  # ASCII white space and control characters
BLANK[:33] = BLANK[127] = True

#: white space beyond ASCII
WIDE_SPACE = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)) + (b"\x1c", b"\x1d", b"\x1e", b"\x1f")

_GEAR = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)


def cuts(data: np.ndarray, offs: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Starts of the chunks of texts laid end to end (``offs``: the texts' offsets).

    A chunk ends behind a byte where the rolling hash of the last ``LOOKBACK`` bytes has ``bits`` leading zeros,
    if the byte before had none (so a text of one repeated character is not cut), and never
    within a character.
    """
    n = len(data)
    h = _GEAR[data]
    step = 1
    while step < LOOKBACK:
        older = np.zeros_like(h)
        older[step:] = h[:n - step] if n > step else 0
        h = h + (older << np.uint64(step))
        step *= 2
    hit = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)) == 0
    hit[1:] &= ~hit[:-1]
    cut = np.zeros(n + 1, bool)
    cut[1:] = hit
    near = offs[:-1, None] + np.arange(1, LOOKBACK)  # there the hash would look into the text before
    cut[np.minimum(near, n).ravel()] = False
    cut[:n] &= (data & 0xC0) != 0x80
    cut[offs] = True
    cut[n] = False
    return np.flatnonzero(cut)


def fixed_points(data: np.ndarray) -> np.ndarray:
    """Places with ASCII white space behind and another character before. Behind a character that
    may be white space beyond ASCII none is taken: fewer fixed points only make windows longer."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    ok = SPACE[data[1:]] & ~BLANK[data[:-1]]
    ok[1:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
    if len(data) > 3:
        lead, mid = data[:-3], data[1:-2]
        ok[2:] &= ~((lead >= 0xE1) & (lead <= 0xE3) & ((mid == 0x80) | (mid == 0x81) | (mid == 0x9A)))
    return np.flatnonzero(ok) + 1


def gather(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """The byte ranges [lo, hi) as an Arrow array."""
    size = hi - lo
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.repeat(lo - ends[:-1], size) + np.arange(ends[-1])]
    wide = ends[-1] >= 1 << 31
    return pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(lo),
                                 [None, pa.py_buffer(ends.astype(np.int64 if wide else np.int32)), pa.py_buffer(flat)])


class ChunkEncoder:
    """Encodes columns of texts as the ``tokenizers`` vocabulary file at ``path`` does (no
    special tokens added, truncation and padding off); only for byte-level pre-tokenisers
    that split at blanks and add no prefix blank."""

    def __init__(self, path: str, bits: int = CUT_BITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.bits = bits
        self.chunks, self.windows = WordCache("chunkbpe", 400_000), WordCache("chunkbpe", 400_000)
        added = self.tok.get_added_tokens_decoder()
        bad = [t.content for t in added.values() if " " in t.content or t.lstrip or t.rstrip or t.normalized or t.single_word]
        if bad or self.tok.normalizer is not None:
            raise ValueError(f"chunks need a vocabulary without normaliser or blanks in added tokens: {bad}")
        plain = {c: i for i, c in enumerate(byte_alphabet())}
        names = self.tok.get_vocab(with_added_tokens=True)
        parts = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            special = i in added or any(c not in plain for c in name)
            parts[i] = name.encode() if special else bytes(plain[c] for c in name)
        self.lens = np.array([len(p) for p in parts], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def encode_strings(self, strings: list[bytes]) -> list[bytes]:
        """Ids (little-endian, four bytes) of each string. Strings from one fixed point to another are encoded
        in lines of many, as their joints are fixed points too; the others one by one."""
        out: list = [b""] * len(strings)
        both = [s[:1].isspace() and not (s[-1:].isspace() or s.endswith(WIDE_SPACE)) for s in strings]
        inner = [i for i, x in enumerate(both) if x]
        sizes = np.array([len(strings[i]) for i in inner], dtype=np.int64)
        ends = np.cumsum(sizes)
        edges = np.flatnonzero(np.diff((ends - sizes) // LINE_BYTES, prepend=-1)).tolist() + [len(inner)]
        lines = list(zip(edges, edges[1:])) if inner else []
        texts = [b"".join([strings[i] for i in inner[lo:hi]]).decode() for lo, hi in lines]
        for (lo, hi), coded in zip(lines, self.tok.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(coded.ids, dtype="<u4")
            done, want = np.cumsum(self.lens[ids]), ends[lo:hi] - (ends[lo] - sizes[lo])
            at = np.searchsorted(done, want)
            assert (done[at] == want).all(), "a token spans a fixed point"
            raw, cut = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
            for i, a, b in zip(inner[lo:hi], cut, cut[1:]):
                out[i] = raw[a:b]
        rest = [i for i, x in enumerate(both) if not x and strings[i]]
        for i, coded in zip(rest, self.tok.encode_batch_fast([strings[i].decode() for i in rest], add_special_tokens=False)):
            out[i] = np.array(coded.ids, dtype="<u4").tobytes()
        return out

    def lookup(self, cache: WordCache, strings: list[bytes]) -> list[bytes]:
        """Ids of the strings, from the cache where they are short enough to be kept there."""
        short = [s for s in strings if len(s) <= KEEP_BYTES]
        known = iter(cache.fill(short, self.encode_strings))
        if len(short) == len(strings):
            return list(known)
        rest = iter(self.encode_strings([s for s in strings if len(s) > KEEP_BYTES]))
        return [next(known) if len(s) <= KEEP_BYTES else next(rest) for s in strings]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and each row's offsets into them."""
        data, offs = text_bytes(texts)
        data = np.ascontiguousarray(data)
        rows = len(offs) - 1
        starts = cuts(data, offs, self.bits)
        ends = np.append(starts[1:], len(data))
        fixed = fixed_points(data)
        # first and last fixed point strictly within each chunk
        lo, hi = np.searchsorted(fixed, starts, "right"), np.searchsorted(fixed, ends, "left")
        some = lo < hi
        # a seam that is a fixed point itself settles both sides
        seam = starts[np.isin(starts, fixed, assume_unique=True) & ~np.isin(starts, offs)]
        first = np.concatenate([fixed[lo[some]], seam])
        order = first.argsort(kind="stable")
        first, last = first[order], np.concatenate([fixed[hi[some] - 1], seam])[order]
        row = np.searchsorted(offs, first, "right") - 1
        # windows: from the row's start or a chunk's last fixed point to the next chunk's first one or the row's end
        j, h = np.arange(len(first)), np.searchsorted(row, np.arange(rows + 1))
        left, right = np.empty(len(first) + rows, np.int64), np.empty(len(first) + rows, np.int64)
        d = np.arange(rows)
        left[h[:-1] + d], left[j + row + 1] = offs[:-1], last
        right[h[1:] + d], right[j + row] = offs[1:], first
        windows = gather(data, left, right).dictionary_encode()
        settled = gather(data, first, last).dictionary_encode()
        coded = self.lookup(self.windows, windows.dictionary.to_pylist())
        split = len(coded)
        coded += self.lookup(self.chunks, settled.dictionary.to_pylist())
        order = np.empty(2 * len(first) + rows, np.int64)
        window_row = np.repeat(d, np.diff(h) + 1)
        order[2 * np.arange(len(left)) - window_row] = np.asarray(windows.indices)
        order[2 * j + row + 1] = np.asarray(settled.indices) + split
        lens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        ids, at = expand(np.frombuffer(b"".join(coded), "<u4"), lens, order)
        return ids, at[2 * h + np.arange(rows + 1)]

    def decode_flat(self, ids: np.ndarray, ptr: np.ndarray) -> list[bytes]:
        """Bytes of each row of ids; what is not UTF-8 is replaced, as the library does."""
        flat, at = expand(self.flat, self.lens, ids)
        raw, at = flat.tobytes(), at[ptr].tolist()
        return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(at, at[1:])]


def byte_alphabet() -> list[str]:
    """The characters by which byte-level vocabularies write the 256 bytes: visible Latin-1
    characters stand for themselves, the others for 256, 257, ... in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_WORKER: dict = {}


def encoder(path: str, bits: int = CUT_BITS) -> ChunkEncoder:
    if (path, bits) not in _WORKER:
        _WORKER[path, bits] = ChunkEncoder(path, bits)
    return _WORKER[path, bits]


def _encode(batches, path, bits):
    enc = encoder(path, bits)
    for batch in slices(batches, "text"):
        ids, ptr = enc.encode_column(batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "ids"])


def _decode(batches, path):
    enc = encoder(path)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.column("ids").slice(k, 1)
            ids = np.asarray(pc.drop_null(row.flatten()), dtype=np.int64)
            text = enc.decode_flat(ids, np.array([0, len(ids)]))[0].decode()
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(k, 1), pa.array([text])], names=["id", "text"])


def _round_trip(batches, path, bits):
    enc = encoder(path, bits)
    for batch in slices(batches, "text"):
        ids, ptr = enc.encode_column(batch.column("text"))
        raw, at = ids.astype("<u4").tobytes(), (4 * ptr).tolist()
        back = enc.decode_flat(ids.astype(np.int64), ptr)
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array(np.diff(ptr), pa.int64()),
            pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", bits: int = CUT_BITS) -> DataFrame:
    """``(id, ids array<int>)`` per row: the ids that the vocabulary file at ``path`` gives the whole text.

    A null or empty text has no ids. Null and repeated ids, repeated rows and other columns make no
    difference; the string of an added token in a text becomes that token; an empty table gives no rows.
    Memory per task: a slice of about 4 MB of text (one whole text, where that is longer) and
    the bounded caches of chunks and windows.
    """
    return map_rows(_rows(df, id_col, text_col), partial(_encode, path=path, bits=bits), "id long, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)``: the text that each row's ids stand for, special tokens written out (null or empty ids:
    empty text; null ids within a row are passed over)."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_rows(rows, partial(_decode, path=path), "id long, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", bits: int = CUT_BITS) -> DataFrame:
    """Encode and decode each row in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return map_rows(_rows(df, id_col, text_col), partial(_round_trip, path=path, bits=bits),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
