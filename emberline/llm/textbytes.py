"""Vectorised words, lines and hashes over the UTF-8 bytes of an Arrow string column.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``. Hashes are a
polynomial over a fixed random byte table modulo 2**64, finished by a bit mixer, so
they are the same in every process and do not depend on where a word stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; longer texts are taken whole.
SLICE = 1 << 20
#: Bytes that are hashed at once, cut at word starts.
BLOCK = 1 << 18
ROOT = 0x9E3779B97F4A7C15 | 1
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ROOT**i and ROOT**-i modulo 2**64 for i < n."""
    inverse = pow(ROOT, -1, 1 << 64)
    up, down = np.full(n, ROOT, U), np.full(n, inverse, U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Words(NamedTuple):
    """Words of a slice of rows: row within the slice, byte range, 64-bit key."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and len + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    parts = col.buffers()
    if len(col) == 0 or parts[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(parts[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(parts[2], np.uint8) if parts[2] is not None and parts[2].size else np.zeros(0, np.uint8)
    return data, offs


def slices(col: pa.Array, limit: int = SLICE, most: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    data, offs = buffers(col)
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j), i + most)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def spans(text: np.ndarray, offs: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes where ``out`` is false, none of them across rows."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~out
    first = inside.copy()
    first[1:] &= out[:-1]
    last = inside.copy()
    last[:-1] &= out[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def keys(text: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """64-bit hashes of the byte ranges, which are in order and don't overlap; another ``table`` of bytes gives other hashes."""
    out = np.empty(len(start), U)
    if not len(start):
        return out
    edges = np.unique(np.searchsorted(start, np.arange(0, int(end[-1]) + BLOCK, BLOCK)))
    edges = np.unique(np.concatenate(([0], edges, [len(start)])))
    for a, b in zip(edges[:-1], edges[1:]):
        s, e = int(start[a]), int(end[b - 1])
        up, down = powers(1 << max(18, int(e - s).bit_length()))
        total = np.zeros(e - s + 1, U)
        np.cumsum(table[text[s:e]] * up[: e - s], out=total[1:])
        lo, hi = start[a:b] - s, end[a:b] - s
        out[a:b] = (total[hi] - total[lo]) * down[lo] + (hi - lo).astype(U) * U(0xA0761D6478BD642F)
    return mix(out)


def words(text: np.ndarray, offs: np.ndarray, lower: bool) -> Words:
    """The words of a slice; ``lower`` folds A-Z."""
    if lower:
        text = LOWER[text]
    start, end = spans(text, offs, SPACE[text])
    row = np.searchsorted(offs, start, side="right") - 1
    return Words(row, start, end, keys(text, start, end))


def windows(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of each run of n words of one row."""
    k = len(w.key) - n + 1
    if k <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(w.row[:k] == w.row[n - 1 :])
    h = np.zeros(len(at), U)
    for j in range(n):
        h = h * U(ROOT) + w.key[at + j]
    return at, mix(h)


def lines(text: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each \\n-split line, the last one included."""
    cut = np.flatnonzero(text == 10)
    row = np.concatenate((np.arange(len(offs) - 1), np.searchsorted(offs, cut, side="right") - 1))
    start = np.concatenate((offs[:-1], cut + 1))
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    end = np.concatenate((start[1:] - 1, [0]))
    final = np.flatnonzero(np.concatenate((row[1:] != row[:-1], [True])))
    end[final] = offs[row[final] + 1]
    return row, start, end


def per_row(row: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Count or sum for each of n rows."""
    if weight is None:
        return np.bincount(row, minlength=n).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(weight, dtype=np.int64)))
    edge = np.searchsorted(row, np.arange(n + 1))
    return total[edge[1:]] - total[edge[:-1]]
