"""Joins and KPIs against the long way round: plain joins and an aggregate over all joined rows."""

from __future__ import annotations

import functools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailstrata.operators import joins
from retailstrata.operators.kpis import product_kpis
from retailstrata.plans import gold, silver

ORDERS = "OrderID string, CustomerID string, ProductName string, OrderAmount double, OrderDate date"
RETURNS = (
    "ReturnID string, OrderID string, CustomerID string, ReturnReason string, ReturnDate date, RefundStatus string, "
    "PickupAddress string, ReturnAmount double, Product string"
)
INVENTORY = "ProductName string, CostPrice double, LastStocked date, Stock int, Warehouse string, Available boolean"


def make_tables(spark, seed: int, hot: bool = False):
    """Small silver tables; with ``hot`` one order, product and customer hold a third of the rows."""
    rng = random.Random(seed)

    def key(prefix, n):
        if hot and rng.random() < 1 / 3:
            return f"{prefix}0"
        return rng.choice([None, *(f"{prefix}{i}" for i in range(n))])

    from datetime import date

    months = [None, date(2025, 1, 5), date(2025, 1, 25), date(2025, 2, 1)]
    amounts = [None, 0.0, 10.0, 20.5, -4.25]
    orders = [(key("o", 40), key("c", 9), key("p", 6), rng.choice(amounts), rng.choice(months)) for _ in range(120)]
    returns = [
        (rng.choice([None, f"r{i}"]), key("o", 50), "C", "Late", None, "pending", "A", 1.5, "P") for i in range(150)
    ]
    stock = [(key("p", 8), rng.choice([None, 1.0, 2.25]), None, rng.choice([None, 3, 8]), "W", True) for _ in range(12)]
    return (
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(returns, RETURNS),
        spark.createDataFrame(stock, INVENTORY),
    )


def joined(orders, returns, inventory):
    o, r, i = orders.alias("o"), returns.alias("r"), inventory.alias("i")
    both = o.join(r, F.col("o.OrderID") == F.col("r.OrderID"), "left")
    return both.join(i, F.col("o.ProductName") == F.col("i.ProductName"), "left").select(
        "o.ProductName", "o.OrderID", "o.CustomerID", "o.OrderAmount", "r.ReturnID", "i.Stock", "i.CostPrice", "o.OrderDate"
    )


def long_kpis(rows, *by):
    orders, returned = F.count("OrderID"), F.count("ReturnID")
    return rows.groupBy(*by).agg(
        orders.alias("Total_Orders"),
        F.count_distinct("CustomerID").alias("Unique_Customers"),
        returned.alias("Total_Returns"),
        F.round(F.try_divide(returned, orders) * 100, 2).alias("Return_Rate_%"),
        F.round(F.sum("OrderAmount"), 2).alias("Total_Revenue"),
        F.round(F.avg("OrderAmount"), 2).alias("Avg_Order_Value"),
        F.sum("Stock").alias("Total_Stock"),
        F.round(F.avg("CostPrice"), 2).alias("Avg_Cost"),
        F.round(F.sum("OrderAmount") - F.sum("Stock") * F.avg("CostPrice"), 2).alias("Net_Profit"),
    )


def bag(df) -> Counter:
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True), (3, True)])
def test_kpis_equal_the_aggregate_over_joined_rows(spark, seed, hot):
    tables = make_tables(spark, seed, hot)
    result, expected = gold.gold_product_kpis(*tables), long_kpis(joined(*tables), "ProductName")
    assert result.dtypes == expected.dtypes
    assert bag(result) == bag(expected)


def test_kpis_by_month_equal_the_aggregate_over_joined_rows(spark, ansi):
    tables = make_tables(spark, 4, hot=True)
    rows = joined(*tables).withColumn("Order_Month", F.trunc("OrderDate", "month"))
    assert bag(gold.gold_kpi_by_product_month(*tables)) == bag(long_kpis(rows, "ProductName", "Order_Month"))


def test_kpis_agree_with_and_without_fan_out_on_unique_right_sides(spark):
    orders, returns, inventory = make_tables(spark, 5)
    orders, returns = orders.dropDuplicates(["OrderID"]), returns.dropDuplicates(["OrderID"])
    one = product_kpis(orders, returns, inventory.dropDuplicates(["ProductName"]).withColumn("Stock", F.lit(0)))
    two = product_kpis(
        orders, returns, inventory.dropDuplicates(["ProductName"]).withColumn("Stock", F.lit(0)), fan_out=False
    )
    assert bag(one) == bag(two)


def test_kpis_without_fan_out_count_every_row_once(spark):
    orders = spark.createDataFrame([("o1", "c", "p", 10.0, None), ("o2", "c", "p", 5.0, None)], ORDERS)
    returns = spark.createDataFrame([("r1", "o1", *[None] * 7), ("r2", "o1", *[None] * 7)], RETURNS)
    stock = spark.createDataFrame([("p", 2.0, None, 3, "A", True), ("p", 4.0, None, 4, "B", True)], INVENTORY)
    (row,) = gold.gold_kpi_no_fanout(orders, returns, stock).collect()
    assert tuple(row) == ("p", 2, 1, 2, 100.0, 15.0, 7.5, 7, 3.0, 15.0 - 7 * 3.0)
    (row,) = gold.gold_product_kpis(orders, returns, stock).collect()
    assert tuple(row) == ("p", 6, 1, 4, 66.67, 50.0, 8.33, 21, 3.0, 50.0 - 21 * 3.0)


def test_return_rate_without_any_order_id_is_null(spark, ansi):
    orders = spark.createDataFrame([(None, "c", "p", 1.0, None)], ORDERS)
    empty = [spark.createDataFrame([], s) for s in (RETURNS, INVENTORY)]
    (row,) = gold.gold_product_kpis(orders, *empty).collect()
    assert tuple(row) == ("p", 0, 1, 0, None, 1.0, 1.0, None, None, None)


def test_kpi_grouping_needs_the_product(spark):
    with pytest.raises(ValueError):
        product_kpis(*make_tables(spark, 1), by=("CustomerID",))


def test_kpi_plan_never_joins_order_rows_with_inventory_rows(spark):
    """Every right side of a join is aggregated to unique keys first."""
    plan = gold.gold_product_kpis(*make_tables(spark, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
    assert "Expand" not in plan and "Window" not in plan


@pytest.mark.parametrize("hot", [False, True])
def test_joined_rows_are_whole(spark, hot):
    tables = make_tables(spark, 6, hot)
    result = gold.enriched_orders(*tables)
    assert bag(result) == bag(joined(*tables).drop("OrderDate"))
    with_returns = gold.orders_left_returns(*tables[:2])
    assert with_returns.count() == joined(*tables[:2], tables[2].limit(0)).count() >= tables[0].count()


def test_left_join_with_null_keys_and_empty_sides(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 7), ("a", 8), (None, 9), ("z", 9)], "k string, w int")
    select = [F.col("l.k"), F.col("l.v"), F.col("r.k").alias("rk"), F.col("r.w")]
    found = bag(joins.left_join(left, right, "k", select))
    assert found == bag(left.alias("l").join(right.alias("r"), F.col("l.k") == F.col("r.k"), "left").select(*select))
    assert bag(joins.left_join(left, right.limit(0), "k", select)) == Counter(
        {("a", 1, None, None): 1, ("b", 2, None, None): 1, (None, 3, None, None): 2}
    )
    assert joins.left_join(left.limit(0), right, "k", select).count() == 0


@pytest.mark.parametrize("rows_each", [1, 2, 5, 1000])
def test_left_join_with_hot_keys_equals_the_plain_one(spark, rows_each, monkeypatch):
    rng = random.Random(rows_each)
    keys = [None, *["hot"] * 5, *(f"k{i}" for i in range(8))]
    left = spark.createDataFrame([(rng.choice([*keys, "left only"]), i % 7) for i in range(80)], "k string, v int")
    right = spark.createDataFrame([(rng.choice([*keys, "right only"]), i % 3) for i in range(90)], "k string, w int")
    select = [F.col("l.k"), F.col("l.v"), F.col("r.k").alias("rk"), F.col("r.w")]
    expected = bag(left.alias("l").join(right.alias("r"), F.col("l.k") == F.col("r.k"), "left").select(*select))
    assert bag(joins.left_join(left, right, "k", select, rows_each)) == expected
    monkeypatch.setattr(joins, "MOST_HOT", 2)
    assert bag(joins.left_join(left, right, "k", select, rows_each)) == expected


def test_left_join_builds_without_jobs_and_shuffles_wide_rows_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(100).selectExpr("id AS k", "id AS wide")
    right = spark.range(50).selectExpr("id AS k", "id AS w")
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    out = joins.left_join(left, right, "k", [F.col("l.k"), F.col("l.wide"), F.col("r.w")])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1, "the hot keys are broadcast to both sides"


def test_joins_read_their_inputs_no_more_often_than_needed(spark, tmp_path):
    """Left sides once, right sides twice, the second time for their keys alone."""
    stored = []
    for i, df in enumerate(make_tables(spark, 1)):
        df.write.parquet(f"{tmp_path}/{i}")
        stored.append(spark.read.parquet(f"{tmp_path}/{i}"))
    for df, scans in ((gold.orders_left_returns(*stored[:2]), 4), (gold.enriched_orders(*stored), 7)):
        # Both sides of a join name the hot keys; their counts are one exchange, reused.
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") <= scans


def test_joins_with_returns_leave_out_rules_that_no_result_needs(spark, conf):
    """Numbers of hot orders are drawn by columns whose rules cost little, not by whole cleaned returns."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    orders, _, inventory = make_tables(spark, 2)
    raw = [(f"r{i}", "o1", " cust1 ", "Late", "01/02/2025", "OK", "A#1", "$1", "P#1") for i in range(5)]
    returns = silver.silver_returns(spark.createDataFrame(raw, ", ".join(f"{c} string" for c in silver.RETURN_NAMES) + ", Product string"))
    few = gold.orders_left_returns(orders, returns).select("OrderID", "ProductName", "ReturnID")
    for df in (few, gold.enriched_orders(orders, returns, inventory)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract" not in plan and "regexp_replace" not in plan


def test_hot_returns_without_ids_equal_the_plain_join(spark, monkeypatch):
    orders, returns, _ = make_tables(spark, 3, hot=True)
    returns = returns.withColumn("ReturnID", F.lit(None).cast("string"))
    found = [bag(gold.orders_left_returns(orders, returns))]
    monkeypatch.setattr(gold, "left_join", functools.partial(joins.left_join, rows_each=2))
    found.append(bag(gold.orders_left_returns(orders, returns)))
    assert found[0] == found[1] and sum(found[0].values()) == joined(orders, returns, spark.createDataFrame([], INVENTORY)).count()


def test_a_hot_right_key_is_split_over_tasks(spark, conf):
    """A right-hand key with a third of the rows: no task gets it whole."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    right = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("payload"))
    left = spark.range(0, n * 2, 1, 8).select(F.col("id").alias("k"))
    select = [F.col("l.k"), F.col("r.payload")]
    rows = joins.left_join(left, right, "k", select, 500).withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == n + (2 * n - 1 - (n - n // 3)), "matches plus unmatched left rows"
    assert sorted(r.payload for r in rows if r.payload is not None) == list(range(n))
    hot = Counter(r.task for r in rows if r.k == 0)
    assert max(hot.values()) <= n // 3 / 2
