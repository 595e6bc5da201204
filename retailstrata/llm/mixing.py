"""Mixing sources to target weights by Poisson replication.

A source with rate r gives each of its documents r copies on average: the number of copies of a document is
the value of a Poisson distribution with mean r at a uniform number taken from a hash of seed and document.
So copies depend on nothing but the document, its source's rate and the seed: no counts are shared between
tasks, reruns agree, and expected amounts meet the targets exactly. The copies are then shuffled globally by
another hash. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import shared_folder

# Means above this are drawn as a sum of equal parts, each of which the distribution function can hold.
PART = 64.0


def uniform(*values: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of the values, joined by colons."""
    digest = F.md5(F.concat_ws(":", *[v.cast("string") for v in values]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def distribution(mean: Column) -> Column:
    """The Poisson distribution function at 0, 1, 2, ... until a further term no longer changes it.

    For a mean up to ``PART``. The length follows from the mean alone: the tail beyond mean + 12 standard
    deviations + 24 is below the last bit of a double.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    zero = F.exp(-mean)
    first = F.struct(zero.alias("term"), zero.alias("sum"), F.array(zero).alias("all"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        total = state["sum"] + term
        return F.struct(term.alias("term"), total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), first, step, lambda state: state["all"])


def rates(
    df: DataFrame,
    size: Column,
    weights: Mapping[str | None, float] | None = None,
    power: float = 0.7,
    total: float | None = None,
    source: str = "source",
) -> DataFrame:
    """One row for each source: ``source``, its ``size`` and ``rate``, the mean number of copies of a document.

    ``weights`` gives each source's share of the result; a source not in it gets none. Without it, shares go
    with size to the ``power``. ``total`` is the size to reach, by default that of the input. A source of
    size 0 has nothing to weigh: its documents are taken once on average. Null is a source of its own.

    The sizes are written to the shared folder, as both the totals and the rates need them.
    """
    wrong = [w for w in [*(weights or {}).values(), 0.0 if total is None else total] if not 0 <= w < float("inf")]
    if wrong:
        raise ValueError(f"weights and total must be finite and not negative: {wrong}")
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/sizes-{uuid4().hex}"
    df.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).cast("double").alias("size")).write.parquet(path)
    sizes = spark.read.parquet(path)
    if weights is None:
        weight = F.pow("size", F.lit(float(power)))
    else:
        given = [F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))) for name, w in weights.items()]
        weight = F.coalesce(*given, F.lit(0.0))
    weighed = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    all_weights, all_sizes = weighed.agg(F.sum("weight"), F.sum("size")).first()
    goal = float(all_sizes or 0.0) if total is None else float(total)
    rate = F.try_divide(F.col("weight") / F.lit(float(all_weights or 0.0) or 1.0) * F.lit(goal), F.col("size"))
    return weighed.select("source", "size", F.coalesce(rate, F.lit(1.0)).alias("rate"))


def copies(rate: Column, steps: Column, *identity: Column) -> Column:
    """Value of the Poisson distribution with this mean at the numbers hashed from ``identity``."""

    def part(number: Column, k: Column) -> Column:
        at = uniform(*identity, k)
        return number + F.size(F.filter(steps, lambda c: c <= at))

    return F.aggregate(F.sequence(F.lit(1), parts(rate)), F.lit(0), part)


def parts(rate: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rate / PART).cast("int"))


def mix(
    df: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    power: float = 0.7,
    total: float | None = None,
    seed: int = 17,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Documents repeated to meet the weights, in random order, with a column ``copy`` from 1 added.

    Sizes are code points of text (null: none). A document is known by its key, one without a key by its text, so
    repeated rows get equal numbers of copies each. A column ``copy`` of the input is replaced. An empty input
    gives an empty result. Rates and weights: see ``rates``; negative or infinite ones are an error. The order follows
    whole rows, so rows that share a key are dealt over all tasks; only rows equal in all columns stay together.
    """
    size = F.coalesce(F.length(F.col(f"`{text}`")), F.lit(0))
    table = rates(df, size, weights, power, total, source)
    mean = F.col("rate") / parts(F.col("rate"))
    # A struct keeps the input's own columns free of clashes.
    table = table.select(
        F.col("source").alias("__source"), F.struct("rate", distribution(mean).alias("steps")).alias("__rate")
    )
    joined = df.drop("copy").join(table, df[f"`{source}`"].eqNullSafe(F.col("__source")), "left").drop("__source")
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.md5(F.col(f"`{text}`").cast("binary")), F.lit("-"))
    number = copies(F.col("__rate.rate"), F.col("__rate.steps"), F.lit(seed), name)
    repeated = joined.withColumn("__n", number).where("__n > 0").drop("__rate")
    rows = repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("__n")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != "copy"])
    shuffled = rows.withColumn("__order", uniform(F.lit(seed), F.lit("order"), name, F.col("copy"), whole))
    return shuffled.repartition("__order").sortWithinPartitions("__order").drop("__order")


def oracle(power: float = 0.7, seed: int = 17) -> str:
    """The rows of ``mix`` over ``documents`` with default parameters, for rates up to ``PART``, in DuckDB's dialect."""
    return f"""WITH RECURSIVE sizes AS (
  SELECT source, cast(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source),
weighed AS (SELECT *, CASE WHEN size > 0 THEN pow(size, {float(power)}) ELSE 0.0 END AS weight FROM sizes),
totals AS (SELECT sum(weight) AS all_weights, sum(size) AS all_sizes FROM weighed),
rates AS (SELECT source, coalesce(weight / (SELECT CASE WHEN all_weights = 0 THEN 1 ELSE all_weights END FROM totals)
  * (SELECT all_sizes FROM totals) / nullif(size, 0), 1.0) AS rate FROM weighed),
steps AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rates
  UNION ALL
  SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM steps
  WHERE k < ceil(rate + 12 * sqrt(rate) + 24)),
drawn AS (SELECT *, cast('0x' || substr(md5('{seed}:' || coalesce(cast(doc_id AS VARCHAR), md5(text), '-') || ':1'), 1, 13) AS BIGINT)
  / {float(1 << 52)} AS u FROM documents),
counted AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS n
  FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.total <= d.u
  GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, cast(unnest(range(1, n + 1)) AS INTEGER) AS "copy" FROM counted"""
