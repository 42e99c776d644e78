"""Numpy helpers over the raw bytes of a batch of texts (used inside tasks).

A batch is one contiguous ``uint8`` buffer plus ``int64`` offsets, taken from
Arrow without copying each text.  Words are maximal runs of bytes outside
0x20 and 0x09-0x0D; UTF-8 never uses those bytes inside a longer character,
so byte-level splitting equals splitting the decoded text.

Hashes of byte runs are polynomial (base odd, modulo 2**64) over a random
64-bit value per byte, taken from one running sum, then mixed; every function
is deterministic across processes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply / xor-shift)."""
    x = x.astype(U64, copy=True)
    x += U64((0x9E3779B97F4A7C15 * (2 * salt + 1)) & (2**64 - 1))
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUE = mix(np.arange(256, dtype=U64), 7)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(10, (n - 1).bit_length())
            self.up, self.down = (_powers(b, size) for b in (self.base, self.inverse))
        return self.up, self.down


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


BYTE_POW = Powers(0x5851F42D4C957F2D)
WORD_POW = Powers(0xD1342543DE82EF95)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([pc.cast(c, pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
    else:
        column = pc.cast(column, pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]), off - off[0]


def slices(offsets: np.ndarray, size: int = 2 << 20):
    """Ranges (i, j) of documents of about ``size`` bytes; at least one document each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of its document."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    black = ~WHITE[data]
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0] = last[-1] = True
    np.logical_not(black[:-1], out=first[1:])
    np.logical_not(black[1:], out=last[:-1])
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] = True
    last[edge - 1] = True
    starts, ends = np.flatnonzero(first & black), np.flatnonzero(last & black) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the given sorted, disjoint byte runs, in blocks of about 1 MB."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        lo, hi = starts[i], ends[j - 1]
        up, down = BYTE_POW.upto(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(BYTE_VALUE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(U64)
        i = j
    return mix(out)


def window_hashes(values: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values (len(values) - k + 1 of them)."""
    n = len(values)
    if n < k:
        return np.zeros(0, U64)
    out = np.empty(n - k + 1, U64)
    for a in range(0, len(out), BLOCK):
        b = min(a + BLOCK, len(out))
        part = values[a : b + k - 1]
        if salt:
            part = mix(part, salt)
        up, down = WORD_POW.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        m = b - a
        out[a:b] = mix((sums[k : k + m] - sums[:m]) * down[:m], salt)
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value (leftmost of ties) in each run of ``width`` values.

    Compares the upper 40 bits; the lower 24 carry the position, so the
    choice depends on the run's content alone.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    low = U64((1 << 24) - 1)
    out = np.empty(n - width + 1, np.int64)
    for a in range(0, len(out), BLOCK):
        b = min(a + BLOCK, len(out))
        part = (values[a : b + width - 1] & ~low) | np.arange(b - a + width - 1, dtype=U64)
        span = 1
        while 2 * span <= width:
            part = np.minimum(part[:-span], part[span:])
            span *= 2
        if width > span:
            part = np.minimum(part[: len(part) - (width - span)], part[width - span :])
        out[a:b] = (part & low).astype(np.int64) + a
    return out


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in arrays that are sorted together."""
    if len(keys[0]) == 0:
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def cut(data: np.ndarray, keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept bytes and their new offsets."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return data[keep], total[offsets]


def cover(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Positions 0..n-1 covered by runs of ``length`` from the given starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1) if len(starts) < 64 else np.add(edge, np.bincount(starts, minlength=n + 1).astype(np.int32), out=edge)
    ends = np.minimum(starts + length, n)
    edge -= np.bincount(ends, minlength=n + 1).astype(np.int32)
    return np.cumsum(edge[:-1]) > 0
