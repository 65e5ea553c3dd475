"""Vectorised text kernels shared by the operators that run numpy in tasks.

All of them work on the UTF-8 buffer of an Arrow string column, a bounded
number of bytes at a time, so a task's memory does not grow with its
partition.  Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only.
A null text is an empty text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19   # bytes of text that a kernel holds at a time (one text may be longer): arrays of some 85 times that
SHINGLE = 5             # words in a shingle

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = _BYTES.copy()
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of the hash base and of its inverse modulo 2**64."""
    if len(cache.get("p", ())) < n:
        with np.errstate(over="ignore"):
            for name, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
                a = np.full(n, base, dtype=_U)
                a[0] = 1
                cache[name] = np.cumprod(a, dtype=_U)
    return cache["p"][:n], cache["i"][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's constants)."""
    with np.errstate(over="ignore"):
        x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as 64-bit-offset strings, nulls as empty texts."""
    a = batch.column(batch.schema.get_field_index(name))
    return a.cast(pa.large_string()).fill_null("")


def chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES):
    """``(first_row, end_row, bytes, offsets)`` of runs of rows of about ``max_bytes``."""
    n = len(texts)
    if n == 0:
        return
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1, offset=texts.offset * 8)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


class Words:
    """Words of a chunk: byte ranges ``start``/``end``, and ``first[d]:first[d+1]`` per document."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.low = LOWER[data]
        n = len(data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        space = SPACE[data]
        before = np.empty(n, dtype=bool)
        before[:1] = True
        before[1:] = space[:-1]
        after = np.empty(n, dtype=bool)
        after[-1:] = True
        after[:-1] = space[1:]
        self.start = np.flatnonzero(~space & (before | edge[:-1]))
        self.end = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)
        self.per_doc = np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.per_doc)), self.per_doc)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        p, inv = _powers(len(self.low) + 1)
        with np.errstate(over="ignore"):
            h = np.zeros(len(self.low) + 1, dtype=_U)
            np.cumsum((self.low.astype(_U) + _U(1)) * p[:-1], out=h[1:])
            w = (h[self.end] - h[self.start]) * inv[self.start]
        return mix(w, 1)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The words at the given positions."""
        s, e = self.start[which], self.end[which]
        size = e - s
        off = np.zeros(len(which) + 1, dtype=np.int64)
        np.cumsum(size, out=off[1:])
        at = np.arange(off[-1]) + np.repeat(s - off[:-1], size)
        return pa.Array.from_buffers(pa.large_string(), len(which),
                                     [None, pa.py_buffer(off), pa.py_buffer(self.low[at])])


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, document)`` of every ``size``-word shingle in document order.

    A document of fewer words gives its whole word sequence as one shingle;
    one without words gives none.  Hashes are 64 bits: two different shingles
    of a pair of documents meet with probability about (set sizes) / 2**64.
    """
    w, n = words.hashes(), words.per_doc
    at = np.maximum(n - size + 1, (n > 0).astype(n.dtype))
    doc = np.repeat(np.arange(len(n)), at)
    first = np.repeat(words.first[:-1] - (np.cumsum(at) - at), at) + np.arange(at.sum())
    have = np.minimum(n, size)[doc]
    h = np.zeros(len(first), dtype=_U)
    with np.errstate(over="ignore"):
        for j in range(size):
            ok = have > j
            if ok.all():
                h = mix(h ^ w[first + j], 2 + j)
            else:
                i = np.flatnonzero(ok)
                h[i] = mix(h[i] ^ w[first[i] + j], 2 + j)
    return h, doc


def unique_per_doc(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, sorted, and their counts per document."""
    if len(h) == 0:
        return h, np.zeros(n_docs, dtype=np.int64)
    out, count = [], np.zeros(n_docs, dtype=np.int64)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    for d in range(n_docs):
        if first[d + 1] > first[d]:
            u = np.unique(h[first[d]:first[d + 1]])
            out.append(u)
            count[d] = len(u)
    return np.concatenate(out), count


def cut(data: bytes, size: int = 2 << 20):
    """``data`` in pieces of about ``size`` bytes that end where a blank stands (or at the end)."""
    at = 0
    while len(data) - at > size:
        end = data.rfind(b" ", at, at + size)
        if end < 0:
            end = data.find(b" ", at + size)
            if end < 0:
                break
        yield data[at:end + 1]
        at = end + 1
    yield data[at:] if at else data
