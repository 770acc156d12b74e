"""Words and word windows of Arrow text batches, as NumPy arrays.

The separators of every contract are ASCII, so words are found on the UTF-8
bytes. A word's key is a 64-bit polynomial hash, taken for all words of a chunk
at once from prefix sums (arithmetic modulo 2**64, odd base, inverse powers);
a window's key is the same over word keys. Keys are mixed, so any bits of them
can be used for partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer document makes a chunk of its own.
CHUNK_BYTES = 1 << 20

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Separator bytes: white space; and everything but letters, digits and bytes over 0x7F.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:0x80] = True
NOT_ALNUM[0x30:0x3A] = NOT_ALNUM[0x41:0x5B] = NOT_ALNUM[0x61:0x7B] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(CHUNK_BYTES + 1, n)
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            full = np.full(size, b, np.uint64)
            full[0] = 1
            tables.append(np.multiply.accumulate(full))
        if size > CHUNK_BYTES + 1:  # of one very long document: not kept
            return tables[0], tables[1]
        _powers[base] = (tables[0], tables[1])
    return _powers[base]


def _spans(weights: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(base, len(weights) + 1)
    total = np.zeros(len(weights) + 1, np.uint64)
    np.cumsum(weights * up[: len(weights)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


@dataclass
class Words:
    """The words of the documents of one chunk. Word k is ``data[starts[k]:ends[k]]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each document, its first word; one more at the end
    _keys: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def keys(self) -> np.ndarray:
        if self._keys is None:
            self._keys = _spans(self.data.astype(np.uint64) + np.uint64(1), _BYTE_BASE, self.starts, self.ends)
        return self._keys

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and keys of all windows of ``length`` words that lie in one document."""
        limit = np.repeat(self.first[1:], self.counts) - length
        at = np.flatnonzero(np.arange(len(self.keys)) <= limit)
        return at, _spans(self.keys, _WORD_BASE, at, at + length)

    def sequences(self) -> np.ndarray:
        """The key of each document's whole word sequence."""
        return _spans(self.keys, _WORD_BASE, self.first[:-1], self.first[1:])

    def documents_of(self, at: np.ndarray) -> np.ndarray:
        """The documents (positions in the chunk) that the words ``at`` lie in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)[at]

    def joined(self, document: int) -> bytes:
        """The document's words, one space between."""
        data = self.data
        a, b = self.first[document], self.first[document + 1]
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True))


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words of the documents ``data[offsets[i]:offsets[i + 1]]``."""
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``chunk_bytes``; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
