"""Words of whole text columns, found and hashed with numpy on the bytes of an Arrow batch.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; hashes ignore the case of A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18  # bytes of text worked on at a time (a longer text is a chunk of its own)

_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so that it can be inverted modulo 2**64
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[LOWER]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = powers(_BASE, 2 * CHUNK), powers(_INVERSE, 2 * CHUNK)


def place_values(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors of the first n + 1 places of a rolling hash, and their inverses."""
    return (_UP, _DOWN) if n < len(_UP) else (powers(_BASE, n + 1), powers(_INVERSE, n + 1))


def texts(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text and the end) of a string column; a null is an empty text."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = col.buffers()
    at = np.frombuffer(ends, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def pieces(batches, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of text, a longer text alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


@dataclass
class Words:
    """All words of a batch in order: row and byte span in `raw`; `at` has the start of each row's text and the end."""

    raw: np.ndarray
    at: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word (A-Z as a-z)."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            low = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, low + CHUNK, "right")))
            high = int(self.end[j - 1])
            n = high - int(low)
            up, down = place_values(n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.raw[low:high]] * up[:n], out=sums[1:])
            s, e = self.start[i:j] - low, self.end[i:j] - low
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            i = j
        return out

    def counts(self) -> np.ndarray:
        """Words in each row."""
        return np.bincount(self.row, minlength=len(self.at) - 1)

    def firsts(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def chars(self) -> np.ndarray:
        """Code points before each byte of `raw` (and at the end), counted over the batch."""
        out = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum((self.raw & 0xC0) != 0x80, out=out[1:])
        return out


def words(batch: pa.RecordBatch, column: str, of: np.ndarray = _IS_WORD) -> Words:
    """The words of a text column: runs of the bytes that `of` marks."""
    raw, at = texts(batch, column)
    inside = of[raw]
    edge = np.zeros(len(raw) + 1, bool)  # a text starts here
    edge[at[:-1][at[:-1] < len(raw)]] = True
    edge[len(raw)] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(raw, at, np.searchsorted(at, start, "right") - 1, start, end)


def shingles(row: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each run of `width` words of one row; a row with fewer words is one run of all of them."""
    n = len(hashes)
    if not n:
        return row, hashes
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    length = np.diff(np.append(first, n))
    out = np.zeros(n, np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    left = np.repeat(first + length, length) - np.arange(n)  # words from here to the row's end
    short = np.repeat(length < width, length)
    span = np.minimum(left, width)
    for k in range(width):
        i = np.flatnonzero(span > k)
        out[i] = mix(out[i] * step + hashes[i + k])
    keep = (left >= width) | (short & (left == np.repeat(length, length)))
    return row[keep], out[keep]


def by_row(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin in `row` (sorted), and the end."""
    return np.searchsorted(row, np.arange(rows + 1))
