"""Words of Arrow text columns as numpy arrays, and their 64-bit names.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D.  UTF-8 never uses those bytes inside a
longer character, so byte runs and character runs agree.  A word's name depends on its bytes alone:
every worker gives equal words equal names without a shared dictionary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INV = U(pow(int(_BASE), -1, 1 << 64))
_BLOCK = 1 << 17  # bytes hashed at once


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; ``seed`` gives independent functions."""
    x = (x + U((0x9E3779B97F4A7C15 * (2 * seed + 1)) & ((1 << 64) - 1))).astype(U)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(256, dtype=U), 7)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=U)


def text_bytes(col, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes in one array, and each row's offsets in it; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays([c.cast(pa.large_string()) for c in col.chunks]) if col.num_chunks else pa.array([], pa.large_string())
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2] if len(col) else None
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return (_LOWER[data] if lower else data), off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the offsets of its words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    sep = _SEP[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = sep[:-1]
    edge[off] = True
    starts = np.flatnonzero(edge[:n] & ~sep)
    edge[:] = True
    edge[: n - 1] = sep[1:]
    edge[off - 1] = True  # off 0 marks the last place, which is an edge anyway
    ends = np.flatnonzero(edge[:n] & ~sep) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name of each word from its bytes, in blocks of bounded size."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _BLOCK)))
        a, b = int(starts[i]), int(ends[j - 1])
        n = b - a
        total = np.zeros(n + 1, U)
        np.cumsum(_BYTE[data[a:b]] * powers(_BASE, n), out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * powers(_INV, n)[s] + (e - s).astype(U)
        i = j
    return mix(out)


def gram_names(names: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A 64-bit name of each run of ``n`` neighbouring words (also over row borders; callers mask those)."""
    m = len(names) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    x, out = mix(names, 11 + seed), np.zeros(m, U)
    base = U((0xD6E8FEB86659FD93 + 2 * seed) | 1)
    for k in range(n):
        out *= base
        out += x[k : k + m]
    return mix(out, seed)
