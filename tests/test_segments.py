"""Exact ranks and tiles, customer segments, calendars, mapping tables and rows set aside."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from retailstrata.operators import lookups, quality, quantiles
from retailstrata.plans import insights, segments

D = dt.date


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@pytest.mark.parametrize("small", [5, 100, 100_000])
def test_rows_at_ranks_equal_a_sort(spark, tmp_path, small):
    rng = random.Random(small)
    # A third of the rows share a value; some are null, some rows are equal altogether.
    rows = [(rng.choice([None, 7.0, 7.0, rng.random(), float("nan")]), rng.choice([None, "a", f"k{rng.randint(0, 900)}"])) for _ in range(3000)]
    df = stored(spark.createDataFrame(rows, "v double, k string").repartition(4), tmp_path / "t")
    whole = [tuple(r) for r in df.orderBy(F.struct("v", "k")).collect()]
    ranks = [0, 1, 599, 600, 1500, 2400, 2998, 2999]
    found = quantiles.rows_at(df, ["v", "k"], ranks, len(rows), small)
    assert list(map(repr, found)) == [repr(whole[r]) for r in ranks]


@pytest.mark.parametrize("rows, n", [(1000, 7), (5, 5), (3, 5), (0, 4), (101, 1)])
def test_tiles_equal_ntile(spark, tmp_path, rows, n):
    rng = random.Random(rows)
    data = [(i, rng.choice([None, 1, 1, 2, rng.randint(0, 50)])) for i in range(rows)]
    df = stored(spark.createDataFrame(data, "id int, v int").repartition(3), tmp_path / "t")
    expected = df.withColumn("tile", F.ntile(n).over(Window.orderBy(F.col("v").asc_nulls_first(), "id")))
    assert sorted(quantiles.tiles(df, ["v", "id"], n, "tile", small=20).collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_tiles_use_no_window(spark, tmp_path):
    df = stored(spark.range(100).withColumn("v", F.col("id") % 3), tmp_path / "t")
    plan = quantiles.tiles(df, ["v", "id"], 4, "tile")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


ORDERS = "OrderID string, CustomerID string, ProductName string, Quantity int, OrderDate date, OrderAmount double"
RETURNS = "OrderID string, ReturnAmount double"


def test_segments_and_profit_by_hand(spark):
    orders = [("o1", "c1", "p", 2, D(2025, 1, 1), 10.0), ("o2", "c1", "q", 1, None, 5.5), (None, "c2", "p", 1, D(2025, 2, 1), 1.0), ("o3", None, "p", 9, None, 9.0)]
    returns = [("o1", 1.5), ("o1", 2.0), ("o9", 7.0), (None, 3.0), ("o2", None)]
    stock = [("p", 1.0), ("p", 2.0), ("q", None)]
    tables = [spark.createDataFrame(rows, s) for rows, s in ((orders, ORDERS), (returns, RETURNS), (stock, "ProductName string, CostPrice double"))]
    rules = [("high", "Value_Class = 2")]
    found = {r["CustomerID"]: r for r in segments.customer_segments(*tables[:2], classes=2, segments=rules).collect()}
    assert tuple(found["c1"])[1:] == (D(2025, 1, 1), 2, 15.5, 1, 2, 2, "high")
    assert tuple(found["c2"])[1:] == (D(2025, 2, 1), 0, 1.0, 2, 1, 1, "regular")
    assert len(found) == 2
    profit = segments.segment_profit(*tables, classes=2, segments=rules)
    rows = {(r["Level"], r["ProductName"], r["Segment"]): tuple(r)[3:] for r in profit.collect()}
    assert rows == {
        ("product and segment", "p", "high"): (1, 1, 10.0, 3.5, 3.0, 3.5),
        ("product and segment", "q", "high"): (1, 1, 5.5, 0.0, 0.0, 5.5),
        ("product and segment", "p", "regular"): (1, 0, 1.0, 0.0, 1.5, -0.5),
        ("product", "p", None): (2, 1, 11.0, 3.5, 4.5, 3.0),
        ("product", "q", None): (1, 1, 5.5, 0.0, 0.0, 5.5),
        ("segment", None, "high"): (2, 2, 15.5, 3.5, 3.0, 9.0),
        ("segment", None, "regular"): (1, 0, 1.0, 0.0, 1.5, -0.5),
        ("all", None, None): (3, 2, 16.5, 3.5, 4.5, 8.5),
    }
    assert segments.customer_segments(*[t.limit(0) for t in tables[:2]]).count() == 0


def test_calendar_has_every_month(spark):
    rows = [("p", D(2025, 1, 9), 10.0), ("p", D(2025, 6, 1), 20.0), ("p", D(2025, 6, 30), 1.0), ("p", D(2026, 1, 2), 4.0), ("p", None, 5.0), ("q", D(2025, 3, 1), None)]
    orders = spark.createDataFrame(rows, "ProductName string, OrderDate date, OrderAmount double")
    found = {(r["ProductName"], r["Order_Month"]): tuple(r)[2:] for r in insights.product_calendar(orders).collect()}
    assert len(found) == 14
    assert found["p", D(2025, 1, 1)] == (1, 10.0, None, 10.0, None)
    assert found["p", D(2025, 2, 1)] == (0, 0.0, -10.0, 5.0, None)
    assert found["p", D(2025, 6, 1)] == (2, 21.0, 21.0, 7.0, None)
    assert found["p", D(2026, 1, 1)] == (1, 4.0, 4.0, 1.33, 10.0)
    assert found["q", D(2025, 3, 1)] == (1, 0.0, None, 0.0, None)
    trend = {r["ProductName"]: tuple(r)[1:] for r in insights.product_trend(orders).collect()}
    assert trend["q"] == (1, None, None, None) and trend["p"][0] == 13 and trend["p"][3] == -6.0


def test_mapping_tables(spark):
    df = spark.createDataFrame([("a", 1), ("z", 2), (None, 3), ("a", 4)], "v string, n int")
    table = spark.createDataFrame([("a", "A"), ("b", "B"), (None, "N")], "k string, w string")
    found = lookups.mapped(df, "v", table, "k", "w", "said")
    assert found.columns == ["v", "n", "said"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("a", 1, "A"), ("z", 2, "z"), (None, 3, None), ("a", 4, "A")], key=str)
    assert {tuple(r) for r in lookups.unmapped(df, "v", table, "k").collect()} == {("z", 1), (None, 1)}
    with pytest.raises(SparkRuntimeException, match="repeated key"):
        lookups.mapped(df, "v", table.unionAll(table.limit(1)), "k", "w", "said").collect()


def test_rows_are_judged_and_counted_in_one_pass(spark, tmp_path):
    rows = [(1, 5.0, D(2025, 1, 2), D(2025, 1, 1)), (2, 0.0, D(2030, 1, 1), None), (3, -1.0, D(2025, 1, 1), D(2025, 1, 1)), (4, None, None, None)]
    df = spark.createDataFrame(rows, "id int, ReturnAmount double, ReturnDate date, OrderDate date")
    checks, counts = quality.return_checks(D(2026, 1, 1)), Observation()
    quality.judged(df, checks, counts).write.parquet(f"{tmp_path}/t")
    found = {r["id"]: (r["Rejected"], r["Reject_Reasons"]) for r in spark.read.parquet(f"{tmp_path}/t").collect()}
    assert found == {1: (False, []), 2: (True, ["AmountPositive", "DateNotInFuture"]), 3: (True, ["AmountPositive", "DateAfterOrder"]), 4: (False, [])}
    (row,) = quality.violations(df, checks).collect()
    assert counts.get == row.asDict() | {"Rejected": 2}
    assert Counter(r for r, _ in found.values())[True] + Counter(r for r, _ in found.values())[False] == counts.get["Rows"]
