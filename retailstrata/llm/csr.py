"""Sparse matrices in compressed rows, in numpy: as much as alignment needs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Products of entries worked out at a time.
EXPANDED = 1 << 19


@dataclass
class Csr:
    """Row ``i`` has the columns ``indices[indptr[i]:indptr[i + 1]]`` with ``data`` in the same places."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    @classmethod
    def incidence(cls, sizes: np.ndarray, indices: np.ndarray, columns: int) -> Csr:
        """A matrix of ones with ``sizes`` entries a row."""
        return cls(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), indices, np.ones(len(indices), np.int64), columns)

    @classmethod
    def counted(cls, row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Csr:
        """How often each pair of row and column occurs."""
        key = row.astype(np.int64) * columns + column
        if len(key) and (key[1:] < key[:-1]).any():
            key = np.sort(key)
        return _summed(key, np.ones(len(key), np.int64), rows, columns)

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        row = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(indptr, row[order], self.data[order], self.rows)

    def row_of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    def _blocks(self, other: Csr) -> Iterator[tuple[int, int]]:
        """Ranges of rows whose products have a bounded number of terms, at least one row each."""
        per_entry = np.diff(other.indptr)[self.indices]
        total = np.concatenate([[0], np.cumsum(per_entry)])[self.indptr]
        lo = 0
        while lo < self.rows:
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + EXPANDED, side="right")) - 1)
            yield lo, hi
            lo = hi

    def times(self, other: Csr) -> Csr:
        """The product, row by row: row ``i`` is the sum of the rows of ``other`` that the entries of row ``i`` name."""
        parts = []
        for lo, hi in self._blocks(other):
            first, last = self.indptr[lo], self.indptr[hi]
            middle, weight = self.indices[first:last], self.data[first:last]
            row = np.repeat(np.arange(hi - lo), np.diff(self.indptr[lo : hi + 1]))
            start, n = other.indptr[middle], other.indptr[middle + 1] - other.indptr[middle]
            at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            key = np.repeat(row * other.columns, n) + other.indices[at]
            value = np.repeat(weight, n) * other.data[at]
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key)
                key, value = key[order], value[order]
            parts.append(_summed(key, value, hi - lo, other.columns))
        indptr = np.concatenate([[0], *[np.diff(p.indptr) for p in parts]]).cumsum()
        empty = [np.zeros(0, np.int64)]
        return Csr(indptr, np.concatenate(empty + [p.indices for p in parts]), np.concatenate(empty + [p.data for p in parts]), other.columns)


def _summed(key: np.ndarray, value: np.ndarray, rows: int, columns: int) -> Csr:
    """From entries in order of ``row * columns + column``, equal ones added up."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    if len(at) < len(key):
        key, value = key[at], np.add.reduceat(value, at)
    row, column = np.divmod(key, columns) if columns else (key, key)
    indptr = np.searchsorted(row, np.arange(rows + 1)).astype(np.int64)
    return Csr(indptr, column, value, columns)
