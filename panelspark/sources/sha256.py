"""SHA-256 of a file in segments, each read by another task.

SHA-256 is a chain: each 64-byte block needs the state left by the one before. ``hashlib`` does not
give that state away, so ``resume`` calls the SHA256 functions of the libcrypto that ``hashlib`` itself is
built on. Eight words and a byte count are all that passes from one task to the next.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from urllib.parse import quote

BLOCK = 64


class _Context(ctypes.Structure):
    """``SHA256_CTX`` of openssl/sha.h."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("bits_low", ctypes.c_uint32), ("bits_high", ctypes.c_uint32),
                ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


class _Sha256:
    """Like ``hashlib.sha256()``, begun after ``done`` bytes (a multiple of ``BLOCK``) with the ``words`` left by them."""

    def __init__(self, lib: ctypes.CDLL, words: list[int] | None, done: int):
        self.lib, self.context = lib, _Context()
        lib.SHA256_Init(ctypes.byref(self.context))
        if words is not None:
            self.context.h[:] = words
            self.context.bits_low, self.context.bits_high = 8 * done & 0xFFFFFFFF, 8 * done >> 32

    def update(self, block: bytes) -> None:
        self.lib.SHA256_Update(ctypes.byref(self.context), ctypes.c_char_p(block), ctypes.c_size_t(len(block)))

    def words(self) -> list[int]:
        return list(self.context.h)

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self.lib.SHA256_Final(out, ctypes.byref(self.context))
        return out.raw.hex()


@functools.cache
def _libcrypto() -> ctypes.CDLL | None:
    """The libcrypto of ``hashlib``, or None where it is not to be had or does not agree with ``hashlib``."""
    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        first = _Sha256(lib, None, 0)
        first.update(b"a" * BLOCK)
        second = _Sha256(lib, first.words(), BLOCK)
        second.update(b"b" * 100)
        return lib if second.hexdigest() == hashlib.sha256(b"a" * BLOCK + b"b" * 100).hexdigest() else None
    except (ImportError, OSError, AttributeError):
        return None


def resume(words: list[int] | None = None, done: int = 0) -> _Sha256 | None:
    """A hash that goes on after ``done`` bytes, or None if this Python cannot leave off and go on."""
    return _Sha256(_libcrypto(), words, done) if _libcrypto() else None


def open_store(path: str):
    """(``pyarrow.fs`` file system, path in it) of a Hadoop path."""
    from pyarrow import fs

    scheme, rest = path.split(":", 1)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def read_segment(path: str, size: int, start: int, words: list[int] | None, segment: int, chunk: int = 1 << 20) -> tuple[int, list[int] | None, str | None]:
    """(bytes done, state, digest once the file is done) after at most ``segment`` more bytes, read in chunks.
    A Python that cannot go on from a state reads the file from its first byte to its last."""
    end, h = min(size, start + max(BLOCK, segment - segment % BLOCK)), resume(words, start)
    if h is None:
        start, end, h = 0, size, hashlib.sha256()
    store, inner = open_store(path)
    with store.open_input_file(inner) as file:
        file.seek(start)
        while start < end:
            block = file.read(min(chunk, end - start))
            if not block:
                raise OSError(f"{path} has {start} bytes, {size} were listed")
            h.update(block)
            start += len(block)
    return (start, None, h.hexdigest()) if start == size else (start, h.words(), None)
