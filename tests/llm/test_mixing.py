"""Poisson copies: their distribution, targets met on average, odd rows, and the shuffle."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailstrata.llm import mixing


def documents(spark, counts: dict, text: str = "abcdefghij"):
    rows = [(i, text, s) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_distribution_function(spark):
    for mean in (0.0, 0.3, 1.0, 7.5, 63.9):
        steps = spark.range(1).select(mixing.distribution(F.lit(mean)).alias("s")).first()["s"]
        exact = [sum(math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean else float(k == 0) for k in range(n + 1)) for n in range(len(steps))]
        assert steps == pytest.approx(exact, abs=1e-12) and steps[-1] == pytest.approx(1, abs=1e-12)


@pytest.mark.parametrize("mean", [0.4, 2.0, 150.0])
def test_copies_are_poisson(spark, mean):
    rate = F.lit(mean)
    steps = mixing.distribution(rate / mixing.parts(rate))
    drawn = spark.range(4000).select(mixing.copies(rate, steps, F.lit(1), F.col("id")).alias("n"))
    n = [r["n"] for r in drawn.collect()]
    average = sum(n) / len(n)
    spread = sum((x - average) ** 2 for x in n) / len(n)
    assert abs(average - mean) < 5 * math.sqrt(mean / len(n)) and 0.85 < spread / mean < 1.15
    if mean < 1:
        assert abs(n.count(0) / len(n) - math.exp(-mean)) < 0.03


def test_weights_are_met(spark):
    df = documents(spark, {"a": 6000, "b": 2000, "c": 1000, "d": 50})
    out = Counter(r["source"] for r in mixing.mix(df, weights={"a": 1, "b": 1, "c": 2}).collect())
    total = 9050
    assert set(out) == {"a", "b", "c"}
    for source, share in (("a", 0.25), ("b", 0.25), ("c", 0.5)):
        assert abs(out[source] - share * total) < 0.06 * total
    rates = {r["source"]: r["rate"] for r in mixing.rates(df, F.length("text"), power=0.5, total=1000.0).collect()}
    assert sum(rates[s] * n * 10 for s, n in {"a": 6000, "b": 2000, "c": 1000, "d": 50}.items()) == pytest.approx(1000)
    assert rates["c"] / rates["a"] == pytest.approx(math.sqrt(6))


def test_reruns_and_partitions_agree(spark):
    df = documents(spark, {"a": 300, "b": 100})
    first = sorted(map(tuple, mixing.mix(df).collect()))
    assert first == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))
    assert first != sorted(map(tuple, mixing.mix(df, seed=3).collect()))
    order = [r["doc_id"] for r in mixing.mix(df).coalesce(1).collect()]
    assert order != sorted(order)


def test_odd_rows(spark):
    rows = [(1, "x", None), (1, "x", None), (None, "y", "s"), (2, None, "t"), (3, "", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit(9) for c in ("rate", "size", "steps", "copy", "weight")}
    )
    out = mixing.mix(df, total=20.0)
    assert set(out.columns) == set(df.columns)
    found = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    assert found[(1, "x", None)] % 2 == 0 and set(found) <= {(1, "x", None), (None, "y", "s"), (2, None, "t"), (3, "", "t")}
    assert mixing.mix(df.limit(0)).count() == 0


def test_no_python_on_the_way(spark):
    plan = mixing.mix(documents(spark, {"a": 5}))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_weights_must_make_sense(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    for wrong in ({"weights": {"s": -1.0}}, {"total": -5.0}, {"weights": {"s": float("nan")}}, {"total": float("inf")}):
        with pytest.raises(ValueError, match="not negative"):
            mixing.mix(df, **wrong)
    assert mixing.mix(df, total=0.0).count() == 0


def test_rows_of_one_key_are_dealt_over_the_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    for key in ("7", "null"):
        df = spark.range(2000).selectExpr(f"cast({key} AS bigint) AS doc_id", "concat('text ', id) AS text", "'s' AS source")
        tasks = [r["count"] for r in mixing.mix(df).groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) == 8 and max(tasks) < 0.2 * sum(tasks)
