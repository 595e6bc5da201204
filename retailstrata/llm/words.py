"""Words, lines and their hashes over the UTF-8 bytes of an Arrow batch of texts, in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return;
all six are single bytes in UTF-8, so bytes and code points give the same words. A null text is an
empty one. Work arrays are made for blocks of about a megabyte, cut between words, so that memory
follows the batch and not its longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (finalizer of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and the offset of each text in them (one more than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range; ranges are in order and don't overlap. Equal bytes, equal hash."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        n = hi - lo
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data[lo:hi]] * _powers(_ODD, n), dtype=np.uint64, out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * _powers(_ODD_INVERSE, n + 1)[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def counts_between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each range."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


@dataclass
class Words:
    """The words of a batch in order: their text's row, byte range and hash."""

    data: np.ndarray
    bounds: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def per_row(self, values: np.ndarray | None = None) -> np.ndarray:
        """Words per text, or the sum of a value of each word."""
        if values is None:
            return np.bincount(self.row, minlength=self.rows).astype(np.int64)
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        edge = np.searchsorted(self.row, np.arange(self.rows + 1))
        return total[edge[1:]] - total[edge[:-1]]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, bounds = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    start = np.flatnonzero(~space & (before | first[:-1]))
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    end = np.flatnonzero(~space & (after | first[1:])) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    return Words(data, bounds, row, start, end, span_hashes(data, start, end))


WHITE = _SPACE


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Spaced:
    """The words of a batch with exactly one space after each, their text's row and their byte range.

    ``joined[i]`` tells whether word ``i`` and the one before it belong together: the same text, and no byte of the
    ``breaks`` between them.
    """

    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    joined: np.ndarray


def spaced_words(data: np.ndarray, bounds: np.ndarray, white: np.ndarray, breaks: np.ndarray | None = None) -> Spaced:
    """``white`` and ``breaks`` are tables of byte values; both end a word."""
    gap = white[data] if breaks is None else white[data] | breaks[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    begins = ~gap
    begins[1:] &= gap[:-1] | first[1:-1]
    seen = np.flatnonzero(~gap)
    word = np.cumsum(begins[seen]) - 1
    count = int(word[-1]) + 1 if len(word) else 0
    out = np.full(len(seen) + count, 0x20, np.uint8)
    out[np.arange(len(seen)) + word] = data[seen]
    size = np.bincount(word, minlength=count)
    end = np.cumsum(size) + np.arange(count)
    at = np.flatnonzero(begins)
    row = np.searchsorted(bounds, at, side="right") - 1
    joined = np.zeros(count, bool)
    joined[1:] = row[1:] == row[:-1]
    if breaks is not None:
        total = np.cumsum(breaks[data])
        joined[1:] &= total[at[1:]] == total[at[:-1]]
    return Spaced(out, row, end - size, end, joined)


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``n`` words within one text."""
    count = len(words.row) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.row[:count] == words.row[n - 1 :])
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        value = mix(value * _ODD + words.hash[at + k])
    return at, value


def repeated(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the same value occurs more than once in its text."""
    own = mix(value ^ mix(row.astype(np.uint64) + _ODD))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    out = np.zeros(len(own), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def seen_before(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the same value occurred earlier in its text."""
    own = mix(value ^ mix(row.astype(np.uint64) + _ODD))
    order = np.argsort(own, kind="stable")
    out = np.zeros(len(own), bool)
    out[order[1:][own[order][1:] == own[order][:-1]]] = True
    return out


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a run of ``n`` words that starts at one of ``at``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def slices(texts: pa.Array, limit: int = BLOCK):
    """Consecutive parts of a batch of about ``limit`` bytes, at least one text each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < len(texts):
        used = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, used + limit, side="right")))
        yield texts.slice(i, j - i)
        i = j
