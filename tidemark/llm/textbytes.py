"""Words of whole Arrow text columns, found and hashed with numpy over the UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_U = np.uint64
#: What separates words: space and the controls from tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=_U)
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BACK = _U(pow(int(_BASE), -1, 2**64))
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, for arrays of uint64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BACK)):
            t = np.full(n, base, _U)
            t[0] = 1
            _tables[name] = np.cumprod(t)
    return _tables["up"][:n], _tables["down"]


class Words(NamedTuple):
    """Words of the documents ``lo`` to ``hi`` of a column; document i has words ``ptr[i]`` to ``ptr[i+1]``."""

    lo: int
    hi: int
    data: np.ndarray  # bytes, A-Z lower-cased
    first: np.ndarray  # where each document's bytes start in data, and the end
    start: np.ndarray  # where each word starts in data
    end: np.ndarray
    ptr: np.ndarray
    hash: np.ndarray


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes and offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs


def slices(offs: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text is a range of its own."""
    lo = 0
    while lo < len(offs) - 1:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def words(col: pa.Array, most: int = 1 << 20) -> Iterator[Words]:
    """The words of a text column, in slices of about ``most`` bytes; a longer document is a slice of its own."""
    raw, offs = text_bytes(col)
    for lo, hi in slices(offs, most):
        data = LOWER[raw[offs[lo] : offs[hi]]]
        first = offs[lo : hi + 1] - offs[lo]
        n = len(data)
        inside = ~BLANK[data]
        before = np.empty(n, bool)
        before[1:] = inside[:-1]
        if n:
            before[0] = False
        after = np.empty(n, bool)
        after[:-1] = inside[1:]
        if n:
            after[-1] = False
        cut = first[:-1][first[:-1] < n]
        before[cut] = False
        after[cut[cut > 0] - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        up, down = _powers(max(n, 1))
        run = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[data] * up, out=run[1:])
        h = mix((run[end] - run[start]) * down[start])
        yield Words(lo, hi, data, first, start, end, np.searchsorted(start, first), h)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's shingles, repeated ones too, and where each document's begin.

    A document with fewer words than ``size`` gives its whole sequence as one, one without words none.
    """
    n = np.diff(w.ptr)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    ptr = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(w.ptr[:-1] - ptr[:-1], count) + np.arange(ptr[-1])
    room = np.repeat(np.minimum(n, size), count)
    out = room.astype(_U)
    for j in range(size):
        has = room > j
        nxt = w.hash[np.minimum(at + j, max(len(w.hash) - 1, 0))] if len(w.hash) else out
        out = np.where(has, mix(out * _U(0xD6E8FEB86659FD93) + nxt), out)
    return out, ptr
