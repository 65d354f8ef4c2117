"""Word, line and span hashes of many texts at once, as NumPy arrays over their UTF-8 bytes.

Texts are taken in chunks of about CHUNK bytes (a longer text is a chunk of its own), so memory follows the longest
text and not the Arrow batch. Hashes are 64 bits wide: polynomials over the bytes, mixed; where equal hashes stand for equal words or
lines, spans of more than SHORT elements are hashed one by one (modulo 2^64, some pairs of 1,024 letters and more have one value for
every odd base).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK = 1 << 19
SHORT = 255
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers = {_BASE: np.ones(1, U), pow(_BASE, -1, 1 << 64): np.ones(1, U)}
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# One odd multiplier for each word of a shingle.
_PLACES = [U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    base = list(_powers)[inverse]
    if len(_powers[base]) < n:
        out = np.full(max(n, 2 * CHUNK), base, U)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


class Chunk:
    """Rows first to last of an Arrow column: bytes, and where each row's begin (offsets has one entry more)."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.rows = len(offsets) - 1
        self.sizes = np.diff(offsets)

    def prefix(self, data: np.ndarray | None = None) -> np.ndarray:
        """Running polynomial; span() takes the hash of any span from it."""
        data = self.data if data is None else data
        out = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(len(data)), out=out[1:])
        return out

    @staticmethod
    def span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """Hashes of spans; data (what the prefix was made of) where they are to tell long spans apart."""
        out = mix((prefix[end] - prefix[start]) * powers(len(prefix), True)[start])
        if data is not None:
            for i in np.flatnonzero(end - start > SHORT).tolist():
                out[i] = xxhash.xxh3_64_intdigest(data[start[i]:end[i]].tobytes())
        return out

    def row_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets[1:], places, side="right")

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum over each row of a value per byte."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offsets])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each word."""
        solid = ~_BLANK[self.data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(solid))]
        begins[edges] = solid[edges]
        ends[edges - 1] = solid[edges - 1]
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, self.row_of(start)

    def shingles(self, size: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each run of `size` words and its row, and the words of each row. Rows with fewer words have no run."""
        start, end, row = self.words()
        data = _LOWER[self.data] if lower else self.data
        word = self.span(self.prefix(data), start, end, data)
        count = np.bincount(row, minlength=self.rows)
        n = len(word) - size + 1
        if n <= 0:
            return np.zeros(0, U), np.zeros(0, np.int64), count
        runs = sum(word[i:i + n] * _PLACES[i] for i in range(size))
        whole = row[:n] == row[size - 1:]
        self.run_at = np.flatnonzero(whole)
        return mix(runs[whole]), row[:n][whole], count


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """The column's texts (null: empty) in chunks."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield Chunk(first, data[at[first]:at[last]], at[first:last + 1] - at[first])
        first = last
