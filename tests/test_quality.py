"""Checks and reports on small hand-written tables (the oracles cover the large ones)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from retailstrata.operators import quality
from retailstrata.operators.money import money
from retailstrata.plans import insights

D = dt.date


def test_violations_count_known_breaks_only(spark, ansi):
    rows = [(5.0, D(2025, 1, 2), D(2025, 1, 1)), (0.0, D(2030, 1, 1), None), (-1.0, D(2025, 1, 1), D(2025, 1, 1)), (None, None, None)]
    df = spark.createDataFrame(rows, "ReturnAmount double, ReturnDate date, OrderDate date")
    (row,) = quality.violations(df, quality.return_checks(D(2026, 1, 1))).collect()
    assert row.asDict() == {"Rows": 4, "AmountPositive": 2, "DateNotInFuture": 1, "DateAfterOrder": 1}


def test_values_outside_a_list(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert {tuple(r) for r in quality.outside_list(df, "v", ["a"]).collect()} == {("b", 2), (None, 1)}


def test_map_values_keeps_unknown_ones(spark, ansi):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    assert [r[0] for r in df.select(quality.map_values(F.col("v"), {"a": "A", "b": "B"})).collect()] == ["A", "z", None]


def test_delay_and_review_flag(spark):
    orders = spark.createDataFrame([("o", D(2025, 1, 30))], "OrderID string, OrderDate date")
    returns = spark.createDataFrame(
        [("o", D(2025, 2, 2), 1000.0), ("o", None, 1000.5), ("x", D(2025, 2, 2), None)],
        "OrderID string, ReturnDate date, ReturnAmount double",
    )
    out = quality.with_order_date(returns, orders).select(quality.days_to_return(), quality.high_value())
    assert sorted(map(tuple, out.collect()), key=str) == [(3, False), (None, False), (None, True)]


def test_trend_compares_with_the_month_before(spark):
    rows = [("p", D(2025, 1, 3), 10.0), ("p", D(2025, 1, 9), 2.0), ("p", D(2025, 2, 1), 30.0), ("p", None, 99.0), ("q", D(2025, 2, 1), 1.0)]
    df = spark.createDataFrame(rows, "ProductName string, OrderDate date, OrderAmount double")
    out = {(r.ProductName, r.Order_Month): tuple(r)[2:] for r in insights.product_month_trend(df, months=2).collect()}
    assert out == {
        ("p", D(2025, 1, 1)): (2025, 1, 12.0, None, 12.0),
        ("p", D(2025, 2, 1)): (2025, 2, 30.0, 18.0, 21.0),
        ("q", D(2025, 2, 1)): (2025, 2, 1.0, None, 1.0),
        ("p", None): (None, None, 99.0, None, None),
    }


def test_sums_lose_nothing(spark, ansi):
    values = [("a", 0.004), ("a", 0.004), ("b", 1e27), ("b", 0.004), ("c", 1e300), ("c", 1.0), ("d", None), ("e", 0.1), ("e", 0.2), ("f", 9e27), ("f", 9e27)]
    df = spark.createDataFrame(values, "k string, v double")
    out = dict(df.groupBy("k").agg(money(F.col("v"))).collect())
    assert out == {"a": 0.008, "b": 1e27, "c": 1e300, "d": None, "e": 0.3, "f": 1.8e28}
    assert df.where("k < 'c'").agg(money(F.col("v"))).first()[0] == 1e27


def test_customer_value_counts_each_order_once(spark):
    orders = spark.createDataFrame(
        [("o1", "c", 10.0), ("o2", "c", 5.0), ("o3", "d", None)], "OrderID string, CustomerID string, OrderAmount double"
    )
    returns = spark.createDataFrame([("o1", 1.25), ("o1", 2.0), ("o1", None)], "OrderID string, ReturnAmount double")
    out = {tuple(r) for r in insights.customer_value(orders, returns).collect()}
    assert out == {("c", 2, 15.0, 3.25, 11.75), ("d", 1, None, 0.0, None)}


def test_turnover_without_stock_is_null(spark, ansi):
    orders = spark.createDataFrame([("p", 3), ("p", 4), ("q", 1), ("s", 1)], "ProductName string, Quantity int")
    stock = spark.createDataFrame([("p", 2), ("p", 2), ("s", 0)], "ProductName string, Stock int")
    out = {tuple(r) for r in insights.inventory_turnover(orders, stock).collect()}
    assert out == {("p", 7, 4, 1.75), ("q", 1, None, None), ("s", 1, 0, None)}
