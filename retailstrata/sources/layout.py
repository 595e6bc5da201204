"""Rows laid out in files so that filters on any of several columns meet few files.

Each column's values are numbered by range, as many ranges as bits allow, cut at values of a bounded sample (they decide
the layout, not the rows). The bits of the numbers are interleaved to one code, and files are ranges of codes: rows
of one file lie close together in all columns, not only in the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import quoted

BITS = 7
# Values drawn of each column to find the ranges.
DRAWN = 4000


def range_cuts(df: DataFrame, column: str, bits: int = BITS) -> list:
    """Values that cut a column into ranges of about equal numbers of rows, at most 2 to the power ``bits``."""
    name = F.col(quoted(column))
    values = df.where(name.isNotNull()).select(name.alias("v"))
    total = values.count()
    drawn = values.sample(min(1.0, DRAWN / max(total, 1)), seed=3).limit(2 * DRAWN).orderBy("v").collect()
    found = [drawn[len(drawn) * i // (1 << bits)]["v"] for i in range(1, 1 << bits)] if drawn else []
    return list(dict.fromkeys(found))


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One code from a number of each column, their highest bits first."""
    out = F.lit(0).cast("bigint")
    for k in range(bits):
        for i, number in enumerate(numbers):
            bit = F.shiftright(number.cast("bigint"), k).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(bit, k * len(numbers) + len(numbers) - 1 - i))
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` partitions by the interleaved ranges of ``columns``; nulls count as the smallest values.

    Rows of one code are divided by all columns of the table, so that a code that very many rows share fills several
    files. ``df`` is read once for each column's sample, so make it a stored table.
    """

    def number(c: str) -> Column:
        cuts, value = range_cuts(df, c, bits), F.col(quoted(c))
        if not cuts:
            return F.lit(0)
        below = F.filter(F.array(*map(F.lit, cuts)), lambda v: v <= value)
        return F.when(value.isNull(), 0).otherwise(F.size(below))

    code = interleaved([number(c) for c in columns], bits)
    rest = F.xxhash64(*map(quoted, df.columns))
    ordered = df.withColumns({"__code": code, "__rest": rest}).repartitionByRange(files, "__code", "__rest")
    return ordered.sortWithinPartitions("__code", *map(quoted, columns)).drop("__code", "__rest")
