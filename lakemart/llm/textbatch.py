"""Vectorised text helpers for Arrow batches.

A batch of texts is handled as one byte array plus document offsets.  Words
are maximal runs of bytes other than the six ASCII blanks (0x20, 0x09-0x0D);
hashes are 64-bit and depend on the bytes alone, so every task and every run
agrees on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2 ** 64 - 1], dtype=np.uint64)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: a bijection that spreads bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``max_bytes`` (one row at least), so
    numpy work space stays bounded whatever a batch holds."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    start, n = 0, len(sizes)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, base + max_bytes, side="right"))
        stop = max(start + 1, min(stop, n))
        yield start, stop
        start = stop


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the n+1 document offsets into it
    (NULL counts as the empty text)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    big = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, dtype=np.int64 if big else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]], off - off[0]


def word_spans(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n+1 word offsets of the
    documents.  A word never crosses a document boundary."""
    ink = np.zeros(len(b) + 2, dtype=bool)
    np.logical_not(BLANK[b], out=ink[1:-1])
    first = np.zeros(len(b) + 1, dtype=bool)
    first[off] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | first[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_spans(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, eight bytes at a time."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _GOLD + _GOLD)
    if not len(starts):
        return h
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    words = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    live, k = np.arange(len(starts)), 0
    while len(live):
        rest = size[live] - k
        part = words[starts[live] + k] & _TAIL[np.minimum(rest, 8)]
        h[live] = mix(h[live] * _GOLD + part)
        k += 8
        live = live[rest > 8]
    return h


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes (may cross documents:
    callers keep the positions that lie inside one)."""
    n = max(0, len(h) - width + 1)
    out = h[:n].copy()
    for k in range(1, width):
        out = mix(out * _GOLD + h[k:k + n])
    return out


def count_per_doc(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set positions in each document's range."""
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def doc_of(off: np.ndarray) -> np.ndarray:
    """Document number of every position of an offset array."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, concatenated."""
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(total)
