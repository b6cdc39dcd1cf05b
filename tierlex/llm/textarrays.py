"""Vectorised views of Arrow text columns: flat bytes, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial and mixing hashes.
BASE = 0x9E3779B97F4A7C15
MIX1 = 0xBF58476D1CE4E5B9
MIX2 = 0x94D049BB133111EB
MASK = (1 << 64) - 1

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below n at least."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(BASE, -1, 1 << 64)
        for name, factor in (("up", BASE), ("down", inverse)):
            a = np.full(size, factor, U64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(MIX1)
    x = (x ^ (x >> U64(27))) * U64(MIX2)
    return x ^ (x >> U64(31))


def small_batches(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about `limit` bytes of text each; one longer text is a slice of its own."""
    for batch in batches:
        _, at = flat(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 offsets at which texts begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, skip = len(column), column.offset
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, skip * (8 if wide else 4)).astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


class Words:
    """Words of a batch of texts, in order.

    A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed and
    carriage return.  `start`, `end`: byte positions; `hash`: 64-bit hash of the word's bytes;
    `doc`: the text's row; `first`: n + 1 offsets into the words by row.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = True):
        n = len(data)
        inside = np.zeros(n + 1, bool)
        inside[:n] = ~WHITE[data]
        begins, stops = inside.copy(), np.zeros(n + 1, bool)
        begins[1:] &= ~inside[:-1]
        stops[1:] = inside[:-1] & ~inside[1:]
        border = at[(at > 0) & (at < n)]
        begins[border] = inside[border]
        stops[border] = inside[border - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops)
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum((LOWER[data] if lower else data).astype(U64) * up[:n] + up[:n], out=sums[1:])
        self._sums, self._down = sums, down
        self.hash = self._hash(self.start, self.end)
        self.first = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(len(at) - 1), np.diff(self.first))

    def _hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(U64) * U64(MIX1))

    def stems(self, n: int) -> np.ndarray:
        """Hashes of the words' first n bytes; a word that isn't longer has its own hash."""
        return self._hash(self.start, np.minimum(self.end, self.start + n))

    def tails(self, n: int) -> np.ndarray:
        """Hashes of the words' last n bytes."""
        return self._hash(np.maximum(self.start, self.end - n), self.end)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive values from each place on; the last n - 1 places are missing."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, U64)
    for i in range(n):
        out = out * U64(BASE) + hashes[i : i + m]
    return mix(out + U64(n))


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values between successive offsets."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
