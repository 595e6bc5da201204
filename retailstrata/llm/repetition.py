"""Quality rules: how much of a text repeats itself.

Repetition is measured as coverage: the share of a text's word characters that lie inside word n-grams
occurring more than once in it, for several lengths, and inside lines that repeat an earlier line.
N-grams are compared by rolling 64-bit hashes in numpy over whole Arrow batches. A repeated long n-gram
consists of repeated short ones, so the long lengths look only where all 3-grams repeat.

Every row is judged alone, without a shuffle; nothing is kept between rows.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Words, counts_between, covered, ngrams, repeated, seen_before, slices, span_hashes, words_of


@dataclass(frozen=True)
class Limits:
    """A text is kept when it has enough words and no share is above its limit.

    ``ngram_chars``: for each n-gram length the largest share of word characters inside repeated n-grams.
    """

    min_words: int = 50
    repeat_percent: int = 50
    line_chars: float = 0.3
    symbol_share: float = 0.05
    ngram_chars: tuple[tuple[int, float], ...] = ((5, 0.5), (7, 0.47), (10, 0.45))


@dataclass
class _Measures:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    dup_line_chars: np.ndarray
    dup_ngram_share: np.ndarray
    base_failed: np.ndarray
    kept: np.ndarray


_TYPES = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "dup_line_chars": "bigint",
    "dup_ngram_share": "double",
    "base_failed": "boolean",
    "kept": "boolean",
}
SCHEMA = "struct<" + ",".join(f"{k}:{v}" for k, v in _TYPES.items()) + ">"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end byte of each line that holds a word."""
    breaks = np.flatnonzero(w.data == 10)
    start = np.unique(np.concatenate([w.bounds[:-1], breaks + 1]))
    end = np.unique(np.concatenate([w.bounds[1:], breaks]))
    # Line k of a word is the last one that starts at or before it; its end is the next end after it.
    first = start[np.searchsorted(start, w.start, side="right") - 1]
    stop = end[np.searchsorted(end, w.start, side="right")]
    first, at = np.unique(first, return_index=True)
    return w.row[at], first, stop[at]


def _measure(texts: pa.Array, limits: Limits) -> _Measures:
    w = words_of(texts)
    char = (w.data & 0xC0) != 0x80
    chars = counts_between(char, w.start, w.end)
    n_words, word_chars = w.per_row(), w.per_row(chars)
    n_symbols = counts_between(_SYMBOL[w.data], w.bounds[:-1], w.bounds[1:])
    row, start, end = _lines(w)
    again = seen_before(row, span_hashes(w.data, start, end))
    n_dup_lines = np.bincount(row[again], minlength=w.rows)
    line_chars = np.zeros(len(row), np.int64)
    np.add.at(line_chars, np.searchsorted(start, w.start, side="right") - 1, chars)
    dup_line_chars = np.bincount(row[again], weights=line_chars[again], minlength=w.rows).astype(np.int64)

    at, value = ngrams(w, 3)
    twice = repeated(w.row[at], value)
    n_repeat_words = w.per_row(covered(at[twice], 3, len(w.row)))
    starts = np.zeros(len(w.row) + 1, bool)
    starts[at[twice]] = True
    floor = np.maximum(word_chars, 1)
    share = np.zeros(w.rows)
    too_much = (dup_line_chars > limits.line_chars * floor) | (n_symbols > limits.symbol_share * floor)
    for n, most in limits.ngram_chars:
        inside = covered(_repeated_ngrams(w, starts, n), n, len(w.row))
        part = w.per_row(np.where(inside, chars, 0)) / floor
        too_much |= part > most
        share = np.maximum(share, part)
    base_failed = (n_words < limits.min_words) | (100 * n_repeat_words > limits.repeat_percent * n_words)
    return _Measures(
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, share, base_failed,
        ~base_failed & ~too_much,
    )


def _repeated_ngrams(w: Words, starts: np.ndarray, n: int) -> np.ndarray:
    """First words of the n-grams (n > 3) that occur more than once in their text.

    ``starts`` flags the words that start a repeated 3-gram.
    """
    run = np.concatenate([[0], np.cumsum(starts)])
    at = np.flatnonzero(starts[: max(0, len(w.row) - n + 1)])
    at = at[run[at + n - 2] - run[at] == n - 2]
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        value = value * np.uint64(0x2545F4914F6CDD1D) + w.hash[at + k]
    return at[repeated(w.row[at], value)]


def repetition(text: Column, limits: Limits = Limits()) -> Column:
    """Measures and verdict of a text as a struct.

    Fields: ``n_words``; ``word_chars``, code points in words; ``n_symbols``, characters of ``#*$%&|<>``;
    ``n_dup_lines``, lines with a word that equal an earlier line; ``n_repeat_words``, words inside a run of
    three words found more than once; ``dup_line_chars``, word characters in such lines;
    ``dup_ngram_share``, the largest share of word characters inside repeated n-grams over all lengths;
    ``base_failed``, too few words or too many repeated ones; ``kept``.

    A null or empty text has no words, all measures zero, and is not kept.
    """

    @F.arrow_udf(SCHEMA)
    def measure(texts: pa.Array) -> pa.Array:
        parts = [_measure(part, limits) for part in slices(texts)]
        names = [f.name for f in fields(_Measures)]
        whole = [np.concatenate([getattr(p, n) for p in parts]) if parts else np.zeros(0) for n in names]
        kinds = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
        return pa.StructArray.from_arrays([pa.array(x, kinds[_TYPES[n]]) for x, n in zip(whole, names)], names)

    return measure(text)


def kept_rows(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text is kept, with the columns they had. Null texts go; repeated rows stay."""
    return df.where(repetition(df[f"`{text}`"], limits)["kept"])
