"""Words of UTF-8 text and hashes of word runs, vectorised with numpy over a block of texts.

Hashes are polynomials modulo 2**64 with an odd base, read off prefix sums, and mixed at the end. They
don't depend on the block that a text happens to be in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_OTHER = 0xD1B54A32D192ED03
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1); the longest asked for so far is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * BLOCK_BYTES)
        steps = np.full(size, base & _MASK, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


_INVERSE = pow(_BASE, -1, 1 << 64)


def _runs(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[first:end] for each pair, whatever lies around it."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=sums[1:])
    return mix((sums[end] - sums[first]) * _power(_INVERSE, len(values) + 1)[first])


@dataclass
class Words:
    """Words of a block: row of the text, byte range and hash of each; `first` has each row's first word and the end."""

    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, n: int, other: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of n words within one text; `other` gives a second hash."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.row[n - 1 :] == self.row[:m])
        return at, _runs(mix(self.hash ^ np.uint64(_OTHER)) if other else self.hash, at, at + n)

    def whole(self) -> np.ndarray:
        """Hash of each text's whole word sequence."""
        return _runs(self.hash, self.first[:-1], self.first[1:])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the offsets of each; null is empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    at = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Pieces of a column of about `most` bytes (one text at least), with the row that each begins at."""
    offsets, row = raw(column)[1], 0
    while row < len(column):
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, column.slice(row, upto - row)
        row = upto


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; before each, and at the end, memory that Arrow keeps of earlier ones goes back to the system.

    A worker lives on from step to step, and what its pool keeps adds up to several batches.
    """
    pool = pa.default_memory_pool()
    try:
        for batch in batches:
            yield batch
            del batch
            pool.release_unused()
    finally:
        pool.release_unused()


def words(texts: pa.Array, lower: bool = False, marks: bool = False) -> Words:
    """The words [^\\x20\\x09-\\x0D]+ of a block of texts; `lower` lower-cases A-Z first.

    With `marks`, words are runs of ASCII letters, digits and other non-ASCII characters, and every other
    character that isn't blank is a word of its own.
    """
    data, offsets = raw(texts)
    if lower:
        data = _LOWER[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    text = np.zeros(n + 2, bool)
    text[1:-1] = _LETTER[data] if marks else ~_BLANK[data]
    first = text[1:-1] & (~text[:-2] | edge[:-1])
    last = text[1:-1] & (~text[2:] | edge[1:])
    if marks:
        alone = ~_BLANK[data] & ~text[1:-1]
        first, last = first | alone, last | alone
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    return Words(data, row, start, end, _runs(_BYTE[data], start, end), at)


def sets(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each of n rows, ascending within the row, and where each row begins."""
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(n + 1))
