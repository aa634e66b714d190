"""Words of Arrow text batches as numpy arrays, for tasks that need every word of every text.

A batch's texts lie one after another in one buffer, so word borders, word hashes and n-gram hashes
are computed for many texts at once, without a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone and whole.
BLOCK = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def byte_class(separators: bytes) -> np.ndarray:
    """Truth table over bytes: whether a byte belongs to a word."""
    kind = np.ones(256, dtype=bool)
    kind[np.frombuffer(separators, dtype=np.uint8)] = False
    return kind


#: Words between white space, and words of letters and digits (other bytes than ASCII signs).
NOT_BLANK = byte_class(b" \t\n\x0b\f\r")
ALPHANUMERIC = byte_class(bytes(b for b in range(128) if not chr(b).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int, factor: np.uint64, cache: dict = {}) -> np.ndarray:  # noqa: B006
    """factor**0 ... factor**(n-1) modulo 2**64; kept for the worker's life."""
    key = int(factor)
    have = cache.get(key)
    if have is None or len(have) < n:
        size = max(n, 2 * BLOCK)
        steps = np.full(size, factor, dtype=np.uint64)
        steps[0] = 1
        have = cache[key] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts. ``first``, ``n``: the texts' rows in the batch."""

    first: int
    n: int
    data: np.ndarray  # lowered bytes
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # text of each word, from 0
    text_starts: np.ndarray
    text_ends: np.ndarray
    sums: np.ndarray | None = field(default=None, repr=False)  # of the bytes so far, for hashes

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return self.span_hashes(self.starts, self.ends)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of spans of bytes: equal bytes, equal hash."""
        if not len(starts):
            return np.empty(0, dtype=np.uint64)
        if self.sums is None:
            self.sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_SEEDS[self.data] * _powers(len(self.data), _FACTOR), dtype=np.uint64, out=self.sums[1:])
        return mixed((self.sums[ends] - self.sums[starts]) * _powers(len(self.data), _INVERSE)[starts])

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)

    def word(self, k: int) -> str:
        return self.data[self.starts[k] : self.ends[k]].tobytes().decode("utf-8", "replace")


def grams(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words within a text, and the position of each run's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * _GRAM + hashes[k : k + n]
    inside = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return mixed(total[inside]), inside


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the n + 1 offsets of a string column; null as the empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    width = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), bounds


def blocks(column: pa.Array, kind: np.ndarray = NOT_BLANK, lower: bool = True) -> Iterator[Words]:
    """The column's words, block by block in row order; every text lies whole in one block."""
    if not len(column):
        return
    data, bounds = _buffer(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + BLOCK, "right")) - 1)
        stop = min(stop, rows)
        part = data[bounds[row] : bounds[stop]]
        text_starts, text_ends = bounds[row:stop] - bounds[row], bounds[row + 1 : stop + 1] - bounds[row]
        if lower:
            part = LOWER[part]
        inside = np.zeros(len(part) + 2, dtype=bool)
        inside[1:-1] = kind[part]
        # a word starts where the byte before is no word byte or where a text starts
        starts = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        borders = text_starts[(text_starts > 0) & (text_starts < len(part))]
        starts[borders] = inside[1:-1][borders]
        ends[borders - 1] = inside[1:-1][borders - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        doc = np.searchsorted(text_ends, starts, "right")
        yield Words(row, stop - row, part, starts, ends, doc, text_starts, text_ends)
        row = stop
