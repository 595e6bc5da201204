"""Exact quantiles and tiles of a whole table, without a sort of all rows and without a window over them.

The rows at given ranks are narrowed down: cuts drawn from a sample divide the range that holds a rank, rows between
neighbouring cuts are counted, and the one part that holds the rank is divided again, until it is small enough to be sorted on
its own. The sample decides how many rounds that takes, the counts are of all rows, so the result is exact.
Ranks follow whole tuples of columns; with a key among them a value that a third of the rows share is divided like any
other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import quoted

# Parts a range is divided into, rows drawn to find them, and rows of a range that is sorted as it is.
PARTS = 64
DRAWN = 2000
SMALL = 10_000


@dataclass(frozen=True)
class _Range:
    """Rows from ``low`` on (or above it) and below ``high``; ``before`` rows are smaller."""

    low: tuple | None
    high: tuple | None
    before: int
    rows: int
    above: bool = False

    def same(self, other: _Range) -> bool:
        return repr((self.low, self.high, self.above)) == repr((other.low, other.high, other.above))


class _Order:
    def __init__(self, df: DataFrame, by: Sequence[str]) -> None:
        self.df, self.by, self.row = df, list(by), F.struct(*[F.col(quoted(c)).alias(c) for c in by])
        self.types = [df.schema[c].dataType for c in by]

    def literal(self, value: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(value, self.types, self.by)])

    def rows(self, r: _Range) -> DataFrame:
        rows = self.df
        if r.low is not None:
            rows = rows.where(self.row > self.literal(r.low) if r.above else self.row >= self.literal(r.low))
        return rows if r.high is None else rows.where(self.row < self.literal(r.high))

    def divided(self, r: _Range) -> list[_Range]:
        """The range in parts, with all their rows counted."""
        drawn = self.rows(r).select(*map(quoted, self.by)).sample(min(1.0, 2 * DRAWN / r.rows), seed=7)
        sample = [tuple(x) for x in drawn.limit(4 * DRAWN).orderBy(self.row).collect()]
        cuts = [*{repr(c): c for c in (sample[len(sample) * i // PARTS] for i in range(1, PARTS))}.values()]
        listed = F.array(*map(self.literal, cuts))
        number = F.size(F.filter(listed, lambda c: c <= self.row))
        counts = dict(map(tuple, self.rows(r).groupBy(number.alias("part")).count().collect()))
        edges, out, before = [r.low, *cuts, r.high], [], r.before
        for i in range(len(cuts) + 1):
            out.append(_Range(edges[i], edges[i + 1], before, counts.get(i, 0), r.above and i == 0))
            before += out[-1].rows
        return out


def rows_at(df: DataFrame, by: Sequence[str], ranks: Sequence[int], total: int, small: int = SMALL) -> list[tuple]:
    """The values of ``by`` in the rows at ``ranks`` (from 0) in ascending order, nulls first.

    ``total`` is the number of rows. ``df`` is read several times: make it a stored table.
    """
    order, divided, found = _Order(df, by), {}, {}
    for rank in sorted(set(ranks)):
        r = _Range(None, None, 0, total)
        while r.rows > small and rank not in found:
            if r not in divided:
                divided[r] = order.divided(r)
            part = next(p for p in divided[r] if p.before <= rank < p.before + p.rows)
            if part.same(r):
                # The sample has one value only: either the row has it, or it is above.
                equal = order.rows(r).where(order.row == order.literal(r.low)).count()
                if rank < r.before + equal:
                    found[rank] = r.low
                part = _Range(r.low, r.high, r.before + equal, r.rows - equal, True)
            r = part
        if rank not in found:
            if r not in divided:
                rows = order.rows(r).select(*map(quoted, by)).orderBy(order.row)
                divided[r] = [tuple(x) for x in rows.collect()]  # ``small`` rows at most
            found[rank] = divided[r][rank - r.before]
    return [found[rank] for rank in ranks]


def tiles(df: DataFrame, by: Sequence[str], n: int, name: str, total: int | None = None, small: int = SMALL) -> DataFrame:
    """``df`` with the number (from 1) of each row's tile when all rows in order of ``by`` are dealt into ``n`` tiles.

    Tiles differ by one row at most, the larger ones first, as ``ntile`` has it; nulls come first. ``by`` must end in
    a key, or equal rows will share a tile. ``df`` must be a stored table.
    """
    total = df.count() if total is None else total
    size, larger = divmod(total, n)
    starts = [t * size + min(t, larger) for t in range(1, n)]
    order = _Order(df, by)
    cuts = rows_at(df, by, [s for s in starts if s < total], total, small)
    tile = sum((F.when(order.row >= order.literal(c), 1).otherwise(0) for c in cuts), F.lit(1))
    return df.withColumn(name, tile.cast("int"))
