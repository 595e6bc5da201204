"""Texts within a few edits of each other, without comparing all pairs.

If one text becomes another by at most d insertions, deletions and replacements, then both become the same text by leaving
out at most d characters of each. So every distinct text is filed under a hash of each text it can be shortened to,
and only texts that share one are compared, each pair once. A hash that very many texts share is dealt over several
tasks: one side's texts have one number each, the other's are repeated for all numbers.

Each text has hundreds of such hashes, which the planner's estimates know nothing of, as they come from an ``explode``: by them a
side would be broadcast, and gathered by the driver first. So all joins here are asked to be merge joins.

The number of ways to shorten a text grows with its length to the power d: made for names and ids and d of 1 or 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import quoted

# Texts filed under one hash and number.
TEXTS_EACH = 1000


def _shorter(c: Column) -> Column:
    """All texts with one character of ``c`` left out."""
    each = F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.char_length(c))))
    return F.when(F.char_length(c) > 0, each).otherwise(F.array().cast("array<string>"))


def shortened(c: Column, most: int) -> Column:
    """Hashes of the texts that remain when at most ``most`` characters are left out."""
    level = F.array(c)
    found = [level]
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, _shorter)))
        found.append(level)
    return F.array_distinct(F.transform(F.flatten(F.array(*found)), lambda x: F.xxhash64(x)))


def close_pairs(left: DataFrame, right: DataFrame | None, most: int, texts_each: int = TEXTS_EACH) -> DataFrame:
    """Pairs ``a``, ``b`` of texts of both sides within ``most`` edits, with their ``distance``.

    Each side has one column of texts. Repeated texts count once, nulls are left out. Without ``right``, pairs
    ``a`` < ``b`` of texts of one side.
    """

    def filed(df: DataFrame, name: str) -> DataFrame:
        texts = df.select(F.col(quoted(df.columns[0])).alias(name)).where(F.col(name).isNotNull()).distinct()
        return texts.select(name, F.explode(shortened(F.col(name), most)).alias("short"))

    a, b = filed(left, "a"), filed(left if right is None else right, "b")
    numbers = F.ceil(F.count(F.lit(1)) / texts_each).cast("int")
    sizes = b.groupBy("short").agg(numbers.alias("numbers"), F.count(F.lit(1)).alias("texts"))
    # Hashes that only one side, or one text, has are of no use.
    sizes = sizes.where("texts > 1") if right is None else sizes.join(a.select("short").distinct().hint("merge"), "short")
    sizes = sizes.drop("texts").hint("merge")
    a = a.join(sizes, "short").withColumn("number", F.explode(F.sequence(F.lit(0), F.col("numbers") - 1))).drop("numbers")
    b = b.join(sizes, "short").withColumn("number", F.pmod(F.xxhash64("b"), F.col("numbers")).cast("int")).drop("numbers")
    pairs = a.join(b.hint("merge"), ["short", "number"]).where(F.abs(F.char_length("a") - F.char_length("b")) <= most).select("a", "b")
    pairs = (pairs.where("a < b") if right is None else pairs).distinct()
    return pairs.withColumn("distance", F.levenshtein("a", "b", most)).where("distance >= 0")


def similar_texts(df: DataFrame, column: str, most: int = 1, texts_each: int = TEXTS_EACH) -> DataFrame:
    """Pairs ``a`` < ``b`` of different texts of a column within ``most`` edits, and how many rows have each."""
    counts = df.where(F.col(quoted(column)).isNotNull()).groupBy(F.col(quoted(column)).alias("text")).agg(F.count(F.lit(1)).alias("rows"))
    texts = counts.select("text")
    pairs = close_pairs(texts, None, most, texts_each)
    for side in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("text").alias(side), F.col("rows").alias(f"rows_{side}")).hint("merge"), side)
    return pairs.select("a", "b", "distance", "rows_a", "rows_b")


def nearest_known(df: DataFrame, column: str, known: DataFrame, most: int = 1, texts_each: int = TEXTS_EACH) -> DataFrame:
    """Each text of a column that is not known, with the nearest known one: ``text``, ``match``, ``distance``, ``ties``.

    ``known`` has one column. Of equally near ones the smallest is given and their number in ``ties``; without any within
    ``most`` edits ``match`` is null and ``ties`` 0.
    """
    name = quoted(column)
    texts = df.select(F.col(name).alias("text")).where(F.col(name).isNotNull()).distinct()
    listed = known.select(F.col(quoted(known.columns[0])).alias("text")).where("text is not null").distinct()
    unknown = texts.join(listed.hint("merge"), "text", "left_anti")
    near = close_pairs(unknown, listed, most, texts_each).groupBy("a", "distance").agg(F.min("b").alias("match"), F.count("b").alias("ties"))
    best = near.groupBy("a").agg(F.min(F.struct("distance", "match", "ties")).alias("best"))
    found = unknown.join(best.hint("merge"), F.col("text") == F.col("a"), "left")
    return found.select("text", "best.match", "best.distance", F.coalesce("best.ties", F.lit(0)).alias("ties"))
