"""Vectorised byte and word primitives on Arrow string batches (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# bytes of text worked on at once: some 20 arrays of 8 bytes each come from one
CHUNK = 1 << 17
_U = np.uint64
# odd multipliers for mixing (any odd 64-bit constants serve)
K1, K2, K3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    h = (h ^ (h >> _U(32))) * K3
    h = (h ^ (h >> _U(29))) * K1
    return h ^ (h >> _U(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a non-null binary Arrow column, without a copy."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    b = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b, o


def chunks(offsets: np.ndarray, limit: int = CHUNK, rows: int = 1 << 31) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes, or of one longer row, and at most ``rows`` rows."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1), i + rows)
        yield i, j
        i = j


class Rolling:
    """Polynomial hashes of byte ranges: prefix sums of R[byte] * M**i, so the
    hash of any range costs one subtraction and one multiplication."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self.m = int(rng.integers(0, 2 ** 61, dtype=np.uint64)) * 8 + 5
        self.inv = pow(self.m, -1, 2 ** 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = 1 << max(16, (n - 1).bit_length())

        def run(m: int) -> np.ndarray:
            out = np.ones(n, np.uint64)
            size, step = 1, m
            while size < n:
                out[size:2 * size] = out[:size] * _U(step)
                step, size = step * step % 2 ** 64, size * 2
            return out
        self.up, self.down = run(self.m), run(self.inv)

    def prefix(self, b: np.ndarray) -> np.ndarray:
        self._powers(len(b) + 1)
        s = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.table[b] * self.up[:len(b)], out=s[1:])
        return s

    def ranges(self, s: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((s[hi] - s[lo]) * self.down[lo] + (hi - lo).astype(np.uint64) * K2)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every window of ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = width - span
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def is_space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


def lower(b: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return b + (((b >= 65) & (b <= 90)).astype(np.uint8) << 5)


def word_bounds(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs without white space) of the rows that ``offsets``
    cut ``b`` into: starts, ends, and the row of each word."""
    n = len(b)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    ws = is_space(b)
    edge = np.zeros(n + 1, bool)
    edge[offsets[(offsets >= 0) & (offsets <= n)]] = True
    inside = ~ws
    start = inside.copy()
    start[1:] &= ws[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ws[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def runs(*keys: np.ndarray) -> np.ndarray:
    """True where a row differs from the row before it in any of ``keys``."""
    n = len(keys[0])
    out = np.ones(n, bool)
    if n:
        out[1:] = False
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated start, start + 1, ... of each range."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return base + np.arange(total)


def multikey_sort(keys: list[np.ndarray], ties_only: int = 0) -> np.ndarray:
    """Row order by keys[0], then keys[1], ...

    Multikey quicksort with 8-byte characters: rows are sorted by one key,
    and only runs that tie on all keys so far are sorted by the next one.
    With ``ties_only`` = k, rows that are alone after the first k keys are
    left out (a suffix whose leading tokens no other suffix has).
    """
    order = np.argsort(keys[0], kind="stable")
    new = runs(keys[0][order])
    for level in range(1, len(keys) + 1):
        alone = new & np.append(new[1:], True)
        if ties_only == level:
            order, new = order[~alone], new[~alone]
            alone = np.zeros(len(order), bool)
        if level == len(keys):
            break
        tied = np.flatnonzero(~alone)
        if len(tied):
            rows = order[tied]
            sub = np.lexsort((keys[level][rows], np.cumsum(new[tied])))
            order[tied] = rows[sub]
            k = keys[level][order]
            new[1:] |= k[1:] != k[:-1]
    return order
