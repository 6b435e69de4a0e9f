"""Texts of a column as flat byte arrays, and words, sums and hashes over them.

Tasks get documents in Arrow batches.  Everything here works on all bytes of a piece
of such a batch at once; a piece holds at most ``PIECE_BYTES`` of text, or one
document, so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2_000_000

#: Space and \t \n \v \f \r separate words in the contracts of the queries.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: ASCII letters and digits, and all bytes of other characters, make the words of a normalised text.
BREAK = np.ones(256, bool)
BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base."""
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Texts:
    """The UTF-8 bytes of some texts laid end to end; a null text has none."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.n = len(offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        if column.null_count:
            column = column.fill_null("")
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        if not len(ends):
            ends = np.zeros(1, np.int64)
        flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(flat[ends[0] : ends[-1]], ends - ends[0])

    def sums(self, marks: np.ndarray) -> np.ndarray:
        """Per text, the sum of a number per byte."""
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def spans(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every maximal run of bytes that are no separators."""
        inside = ~separator
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        before[edges] = False
        after[edges - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every line that has a byte; empty ones have no words either."""
        return self.spans(self.data == 0x0A)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are disjoint, in order and not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    terms = _BYTE_CODES[data[place + np.repeat(starts, lengths)]] * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``size`` words of one text, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mix(out + hashes[i : i + n])
    first = np.flatnonzero(text[:n] == text[size - 1 :])
    return out[first], first


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of text each, or of one row."""
    if not batch.num_rows:
        return
    texts = batch.column(column)
    sizes = np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64)
    block = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
