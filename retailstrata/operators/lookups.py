"""Mapping tables: values are replaced by what a stored table says about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import quoted

_KEY, _VALUE = "__key", "__value"


def unique_entries(table: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; a key that stands in the table twice, even with the same value, is an error when it is read."""
    k = F.col(quoted(key))
    repeated = F.raise_error(F.concat(F.lit(f"repeated key in the mapping of {key}: "), F.col(_KEY).cast("string")))
    rows = table.where(k.isNotNull()).groupBy(k.alias(_KEY)).agg(F.count(F.lit(1)).alias("n"), F.min(quoted(value)).alias(_VALUE))
    # The error takes the place of the value, so it can't be optimised away while the value is used.
    return rows.select(_KEY, F.when(F.col("n") > 1, repeated).otherwise(F.col(_VALUE)).alias(_VALUE))


def mapped(df: DataFrame, column: str, table: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """``df`` with a column ``into``: the mapped value, or the value itself where the table has none.

    Rows are neither lost nor multiplied. Null is mapped to null.
    """
    entries = unique_entries(table, key, value)
    joined = df.join(entries, F.col(quoted(column)) == F.col(_KEY), "left")
    return joined.withColumn(into, F.coalesce(_VALUE, quoted(column))).drop(_KEY, _VALUE)


def unmapped(df: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """How often (``Rows``) each value occurs that the table has no entry for; null counts as such a value."""
    counts = df.groupBy(F.col(quoted(column))).agg(F.count(F.lit(1)).alias("Rows"))
    return counts.join(table.select(F.col(quoted(key)).alias(_KEY)), F.col(quoted(column)) == F.col(_KEY), "left_anti")
