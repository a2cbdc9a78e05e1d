"""Words of many texts at once: NumPy over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
#: Bytes of text in a block (a longer text is a block of its own).
BLOCK_BYTES = 1 << 20
#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWERS = np.cumprod(np.full(1 << 14, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many bytes of text together."""
    lengths = np.asarray(pc.binary_length(column).fill_null(0))
    sums = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = sums[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sums, base + size, side="right")))
        yield start, end
        start = end


class Words:
    """The words of a block of texts: bytes, where each begins and ends, its 64-bit hash, its text's row.

    ``gaps`` marks the bytes between words (256 of them, all below 0x80).
    """

    def __init__(self, texts: pa.Array, lower: bool, gaps: np.ndarray = _SPACE):
        texts = texts.fill_null("") if texts.null_count else texts
        large = pa.types.is_large_string(texts.type)
        _, offsets, data = texts.buffers()
        kind = np.int64 if large else np.int32
        edges = np.frombuffer(offsets, dtype=kind, count=len(texts) + texts.offset + 1)[texts.offset :].astype(np.int64)
        first, last = int(edges[0]), int(edges[-1])
        raw = np.frombuffer(data, dtype=np.uint8, count=last)[first:] if data is not None and last > first else np.empty(0, np.uint8)
        edges = edges - first
        self.rows, self.data = len(texts), raw
        word = ~gaps[raw]
        cut = np.zeros(len(raw) + 1, dtype=bool)
        cut[edges] = True  # texts begin and end here
        begins = word.copy()
        begins[1:] &= ~word[:-1] | cut[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | cut[1:-1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.edges = np.searchsorted(self.starts, edges)  # words of row k: edges[k] to edges[k + 1]
        self.text_starts = edges
        if len(self.starts):
            place = np.arange(len(raw), dtype=np.int64)
            inside = place - np.maximum.accumulate(np.where(begins, place, 0))
            terms = (_LOWER if lower else _SAME)[raw].astype(np.uint64) + _U(1)
            terms *= _POWERS[inside & ((1 << 14) - 1)]
            if inside.max() >= 1 << 14:
                far = np.flatnonzero(inside >> 14)
                terms[far] *= mix((inside[far] >> 14).astype(np.uint64)) | _U(1)
            terms[~word] = 0
            sizes = (self.ends - self.starts).astype(np.uint64)
            self.hashes = mix(np.add.reduceat(terms, self.starts) ^ (sizes << _U(44)))
        else:
            self.hashes = np.empty(0, dtype=np.uint64)

    def row_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.edges))

    def grams(self, n: int, salt: int = 0) -> np.ndarray:
        """Hash of the n words from each word on, also over the end of a text; the last n - 1 are left out."""
        h = self.hashes
        m = len(h) - n + 1
        if m <= 0:
            return np.empty(0, dtype=np.uint64)
        out = np.full(m, 0x51ED270B + salt, dtype=np.uint64)
        for k in range(n):
            out = (out ^ h[k : k + m]) * _U(0x9E3779B97F4A7C15)
            out ^= out >> _U(29)
        return mix(out)


def sequence_hash(hashes: np.ndarray, salt: int = 0) -> int:
    """One hash of a whole sequence of word hashes."""
    out = _U(0x51ED270B + salt + len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            out = (out ^ h) * _U(0x9E3779B97F4A7C15)
            out ^= out >> _U(29)
        return int(mix(np.array([out], dtype=np.uint64))[0])
