"""Left outer joins that stay balanced when one key holds a large share of the rows on either side.

Spark splits an oversized partition of the left side of a left outer join by itself, but never one of the right side.
So keys with very many right rows get several numbers there: a right row has one of them, drawn by a hash of the row, and a
left row with such a key is repeated for each number. The key with its number is joined. A repeated left row that
meets no right row is left out: its key has right rows, so others of its copies meet them.

The keys in question are found beforehand, in the same plan, by sketches of the most frequent keys, made by tasks and merged
in groups of them, of which each names ``MOST_HOT`` keys at most; only those are shuffled and added up. A key with more than a
thousandth of the rows is not missed, and counts that are a little off change the number of numbers and nothing else. So
``MOST_HOT`` keys at most go to every task. Keys without so many rows have the number 0, and the join is a plain one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import quoted

# Right rows of one key and number, and the most keys that get several numbers.
ROWS_EACH = 100_000
MOST_HOT = 1000
# Keys that a sketch keeps track of, and groups of tasks whose sketches are merged first.
_TRACKED = 4096
_GROUPS = 512

_KEY, _NUMBER, _NUMBERS, _THERE = "__key", "__number", "__numbers", "__there"


def hot_keys(right: DataFrame, key: str, rows_each: int = ROWS_EACH) -> DataFrame:
    """The keys with more than ``rows_each`` rows, the most frequent ones, and how many numbers each gets."""
    keys = right.select(F.col(quoted(key)).alias(_KEY)).where(F.col(_KEY).isNotNull())
    sketch = F.expr(f"approx_top_k({_KEY}, {MOST_HOT}, {_TRACKED})")
    some = keys.groupBy(F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("tasks")).agg(sketch.alias("found"))
    listed = some.select(F.explode("found").alias("found")).groupBy(F.col("found.item").alias(_KEY)).agg(F.sum("found.count").alias("n"))
    many = listed.where(F.col("n") > rows_each).orderBy(F.col("n").desc(), _KEY).limit(MOST_HOT)
    return many.select(_KEY, F.ceil(F.col("n") / rows_each).cast("int").alias(_NUMBERS))


def left_join(
    left: DataFrame, right: DataFrame, key: str, select: Sequence[Column], rows_each: int = ROWS_EACH, drawn_by: Sequence[str] | None = None
) -> DataFrame:
    """``left LEFT JOIN right ON l.key = r.key``, projected to ``select``.

    The sides are aliased ``l`` and ``r``; ``select`` names columns as ``F.col("l.x")`` and must give unique output
    names. Null keys never match. The left side is read once, the right one twice: for its keys alone, and whole.

    Numbers are drawn by a hash of all right columns, which makes Spark work out those that ``select`` leaves out too, or of
    ``drawn_by``: rows of a hot key that are alike in these share a number.
    """
    hot = F.broadcast(hot_keys(right, key, rows_each))  # MOST_HOT rows at most
    k = F.col(quoted(key))
    numbers = F.coalesce(F.col(_NUMBERS), F.lit(1))
    copies = left.join(hot, k == F.col(_KEY), "left").drop(_KEY).withColumn(_NUMBER, F.explode(F.sequence(F.lit(0), numbers - 1)))
    drawn = F.pmod(F.xxhash64(*map(quoted, drawn_by or right.columns)), numbers).cast("int")
    dealt = right.where(k.isNotNull()).join(hot, k == F.col(_KEY), "left").withColumn(_NUMBER, drawn).drop(_KEY, _NUMBERS)
    dealt = dealt.withColumn(_THERE, F.lit(True))
    same = (F.col(f"l.{quoted(key)}") == F.col(f"r.{quoted(key)}")) & (F.col(f"l.{_NUMBER}") == F.col(f"r.{_NUMBER}"))
    joined = copies.alias("l").join(dealt.alias("r"), same, "left")
    return joined.where(F.col(f"l.{_NUMBERS}").isNull() | F.col(f"r.{_THERE}")).select(*select)
