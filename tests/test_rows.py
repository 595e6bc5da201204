"""Null handling, duplicates and previews."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from retailstrata.operators import rows
from retailstrata.plans import silver

SCHEMA = "id string, a string, b int, c double"


def test_fill_nulls_spares_empty_text_and_fills_nan(spark):
    df = spark.createDataFrame([("1", None, None, None), ("2", "", 5, math.nan)], SCHEMA)
    filled = rows.fill_nulls(df, {"a": "unknown", "b": 0, "c": 0.0}).orderBy("id").collect()
    assert [tuple(r) for r in filled] == [("1", "unknown", 0, 0.0), ("2", "", 5, 0.0)]


def test_drop_missing_drops_on_any_null(spark):
    df = spark.createDataFrame([("1", None, 1, None), ("2", "", 2, None), (None, "x", 3, None)], SCHEMA)
    assert [r.b for r in rows.drop_missing(df, ["id", "a"]).collect()] == [2]


def random_rows(n: int) -> list[tuple]:
    rng = random.Random(7)
    pick = lambda *v: rng.choice(v)
    return [
        (pick(None, "k1", "k1", "k2", f"k{rng.randrange(40)}"), pick(None, "", "x", "y"), pick(None, 1, 2), pick(None, 0.5, 1.5))
        for _ in range(n)
    ]


def expected_dedup(data: list[tuple]) -> set[tuple]:
    best: dict = {}
    rank = lambda row: tuple((v is not None, v or 0 if not isinstance(v, str) else v) for v in row[1:])
    for row in data:
        if row[0] not in best or rank(row) < rank(best[row[0]]):
            best[row[0]] = row
    return set(best.values())


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_dedup_keeps_the_smallest_row_whatever_the_partitioning(spark, partitions):
    data = random_rows(500)
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    kept = rows.dedup(df, ["id"])
    assert kept.columns == df.columns
    result = [tuple(r) for r in kept.collect()]
    assert len(result) == len(set(result)) and set(result) == expected_dedup(data)


def test_dedup_is_idempotent_and_handles_odd_names(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "w"), (None, "z")], "`a.b` string, `v$` string")
    once = rows.dedup(df, ["a.b"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, rows.dedup(once, ["a.b"]).collect()), key=str)
    assert once.count() == 2
    assert rows.dedup(df.select("`a.b`"), ["a.b"]).count() == 2


def test_dedup_combines_before_its_only_shuffle(spark):
    plan = rows.dedup(spark.createDataFrame([("1", "x", 1, 1.0)], SCHEMA), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange") < plan.index("partial_min")  # the partial step is below the shuffle


def test_preview(spark):
    df = spark.range(100).select(F.col("id").alias("n"))
    assert [r.n for r in rows.preview(df, 3, ["n"]).collect()] == [0, 1, 2]
    assert rows.preview(df, 4).count() == 4


def raw_order(**values):
    base = dict.fromkeys(
        ["Order_ID", "cust_id", "Product_Name", "Qty", "Order_Date", "Order_Amount$", "Delivery_Status",
         "Payment_Mode", "Email", "Ship_Address", "Promo_Code", "Feedback_Score"]
    )
    base |= {"Order_ID": "o1", "cust_id": "c1", "Product_Name": "p1"}
    return tuple((base | values).values())


def test_silver_orders_fill_then_drop_then_dedup(spark, ansi):
    from retailstrata.sources.schemas import RAW_ORDERS

    raw = spark.createDataFrame(
        [
            raw_order(Qty="n/a", Payment_Mode="123"),
            raw_order(Order_ID="o2", cust_id=None),
            raw_order(Order_ID="o3", Product_Name=None),
            raw_order(Order_ID="o4", Qty="two", **{"Order_Amount$": "$9.50"}),
            raw_order(Order_ID="o4", Qty="one", **{"Order_Amount$": "$9.50"}),
            raw_order(Order_ID=None),
            raw_order(Order_ID=None, Qty="3"),
        ],
        RAW_ORDERS,
    )
    out = {r.OrderID: r for r in silver.silver_orders(raw).collect()}
    assert set(out) == {"o1", "o4", None}
    assert (out["o1"].Quantity, out["o1"].OrderAmount, out["o1"].DeliveryStatus, out["o1"].PaymentMode) == (0, 0.0, "unknown", "")
    assert (out["o4"].Quantity, out["o4"].OrderAmount) == (1, 950.0)
    assert out[None].Quantity == 0
    assert dict(silver.silver_orders(raw).dtypes) == {
        "OrderID": "string", "CustomerID": "string", "ProductName": "string", "Quantity": "int", "OrderDate": "date",
        "OrderAmount": "double", "DeliveryStatus": "string", "PaymentMode": "string", "Email": "string",
        "ShipAddress": "string", "PromoCode": "string", "FeedbackScore": "double",
    }


def test_silver_orders_up_to_a_column_equal_the_whole_ones(spark):
    from retailstrata.sources.schemas import RAW_ORDERS

    rng = random.Random(3)
    pick = lambda *v: rng.choice(v)
    data = [
        raw_order(
            Order_ID=pick(None, "o1", "o2", f"o{rng.randrange(30)}"), cust_id=pick(None, "c1", "c2"), Product_Name=pick(None, "p", "q"),
            Qty=pick(None, "one", "7", "x"), Order_Date=pick(None, "2025/01/02", "31-12-2024", "12-31-2024", "?"), Payment_Mode=pick(None, "UPI", "1"),
            **{"Order_Amount$": pick(None, "$1", "Rs. 2", "NaN")},
        )
        for _ in range(400)
    ]
    raw = spark.createDataFrame(data, RAW_ORDERS)
    whole = silver.silver_orders(raw)
    steps = rows.drop_missing(rows.fill_nulls(silver.cleaned_orders(raw), silver.ORDER_DEFAULTS), silver.ORDER_REQUIRED)
    expected = sorted(map(str, rows.dedup(steps, ["OrderID"]).collect()))
    assert sorted(map(str, whole.collect())) == expected
    for last in whole.columns[1:]:
        some = silver.silver_orders(raw, ["CustomerID", last])
        assert some.columns == whole.columns[: whole.columns.index(last) + 1]
        assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(*some.columns).collect()))


def test_the_jvm_compiles_the_code_of_the_orders_queries(spark, conf):
    import re

    from conftest import SF_DIR

    from retailstrata.registry import queries

    conf("spark.sql.adaptive.enabled", "false")  # else the plan has no code before it runs
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    for name in ("silver_orders", "orders_left_returns", "product_calendar", "kpi_counts"):
        text = queries.all_queries()[name](spark, SF_DIR)._jdf.queryExecution().explainString(mode)
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) <= 8000, (name, max(sizes))


def test_reports_compute_no_order_column_that_they_do_not_need(spark):
    from conftest import SF_DIR

    from retailstrata.registry import queries

    for name in ("product_calendar", "customer_value", "kpi_counts", "check_returns", "inventory_turnover"):
        text = queries.all_queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert "ORD_" in text and "Main St" not in text and "PROMO" not in text, name
