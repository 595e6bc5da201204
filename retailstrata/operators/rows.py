"""Row-level operators: null handling, duplicates, previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column name usable in an expression even when it holds dots or other symbols."""
    return "`" + name.replace("`", "``") + "`"


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls (and NaN in floating columns); empty strings stay."""
    return df.fillna(dict(values))


def filled(c: Column, value: object) -> Column:
    """What ``fill_nulls`` makes of one column, as an expression; a fractional ``value`` is for a floating column."""
    return F.coalesce(F.nanvl(c, F.lit(None).cast("double")) if isinstance(value, float) else c, F.lit(value))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of the columns is null (or NaN in floating columns); empty strings stay.

    A condition for each column, so that Spark can use each one before a join where the other column is not known yet.
    """
    there = [F.col(quoted(c)).isNotNull() for c in columns]
    there += [~F.isnan(quoted(c)) for c in columns if df.select(quoted(c)).dtypes[0][1] in ("float", "double")]
    return df.where(reduce(and_, there)) if there else df


def dedup(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by all other columns in order, nulls first.

    Null keys form one group. The choice depends on the rows alone, so reruns, lost executors and
    other partition counts give the same rows. ``min`` of a struct is combined before the shuffle:
    a key that holds a large share of all rows leaves each map task as a single row.

    ``values`` are expressions to take in place of columns. They are worked out by the aggregate, apart from the code
    that Spark generates for the steps before: in one method with those, many rules pass the 8000 bytes of bytecode up to
    which the JVM compiles a method.
    """
    values = values or {}
    others = [values[c].alias(c) if c in values else quoted(c) for c in df.columns if c not in keys]
    if not others:
        return df.select(*map(quoted, keys)).distinct()
    kept = df.groupBy(*map(quoted, keys)).agg(F.min(F.struct(*others)).alias("__kept"))
    fields = {c: F.col("__kept").getField(c) for c in df.columns if c not in keys}
    return kept.select(*[fields[c].alias(c) if c in fields else F.col(quoted(c)) for c in df.columns])


def preview(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows; with ``order_by`` the same ones every time (a distributed top-n, no full sort)."""
    ordered = df.orderBy(*map(quoted, order_by)) if order_by else df
    return ordered.limit(n)
