"""Customer segments by recency, frequency and value, and profit by product and segment.

Orders are read once, to one row per customer and product with counts and sums; customers, segments and profit follow
from those rows, which are kept in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.money import added_parts, money_of, money_parts
from ..operators.quantiles import tiles
from ..sources.scratch import shared_folder

CLASSES = 5
# Name and condition of each segment, the first that holds; classes run from 1 (lowest) to CLASSES.
SEGMENTS: tuple[tuple[str, str], ...] = (
    ("champion", "Recency_Class >= 4 AND Frequency_Class >= 4 AND Value_Class >= 4"),
    ("loyal", "Frequency_Class >= 4"),
    ("big spender", "Value_Class >= 4"),
    ("recent", "Recency_Class >= 4"),
    ("lapsed", "Recency_Class <= 2 AND Frequency_Class <= 2"),
)
OTHER_SEGMENT = "regular"


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def customer_products(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per customer and product: orders, quantity, last order, revenue and returned amount in parts."""
    returned = returns.where("OrderID is not null").groupBy("OrderID").agg(*money_parts(F.col("ReturnAmount"), "returned"))
    rows = orders.select("OrderID", "CustomerID", "ProductName", "OrderAmount", "Quantity", "OrderDate").join(returned, "OrderID", "left")
    return rows.groupBy("CustomerID", "ProductName").agg(
        F.count("OrderID").alias("Orders"),
        F.sum("Quantity").alias("Quantity"),
        F.max("OrderDate").alias("Last_Order"),
        *money_parts(F.col("OrderAmount"), "revenue"),
        *added_parts("returned"),
    )


def segment(segments: Sequence[tuple[str, str]] = SEGMENTS) -> Column:
    out = F.lit(OTHER_SEGMENT)
    for name, condition in reversed(segments):
        out = F.when(F.expr(condition), F.lit(name)).otherwise(out)
    return out


def _segmented(parts: DataFrame, classes: int, segments: Sequence[tuple[str, str]]) -> DataFrame:
    customers = parts.where("CustomerID is not null").groupBy("CustomerID").agg(
        F.max("Last_Order").alias("Last_Order"), F.sum("Orders").alias("Orders"), *added_parts("revenue")
    )
    out = _stored(customers.select("CustomerID", "Last_Order", "Orders", money_of("revenue").alias("Revenue")), "customers")
    total = out.count()
    for value, name in (("Last_Order", "Recency_Class"), ("Orders", "Frequency_Class"), ("Revenue", "Value_Class")):
        out = tiles(out, [value, "CustomerID"], classes, name, total)
    return out.withColumn("Segment", segment(segments))


def customer_segments(
    orders: DataFrame, returns: DataFrame, classes: int = CLASSES, segments: Sequence[tuple[str, str]] = SEGMENTS
) -> DataFrame:
    """Each customer's last order, orders and revenue, their class in each, and the segment these make.

    Classes are equal shares of the customers in order of the value, unknown values first and ties by customer id.
    Orders without a customer make none.
    """
    return _segmented(_stored(customer_products(orders, returns), "customer-products"), classes, segments)


def segment_profit(
    orders: DataFrame, returns: DataFrame, inventory: DataFrame, classes: int = CLASSES, segments: Sequence[tuple[str, str]] = SEGMENTS
) -> DataFrame:
    """Customers, orders, revenue, returned amount, cost and profit per product and segment, with all subtotals.

    ``Level`` tells the rows apart: product and segment, product, segment, all. Cost is the quantity at the product's
    average cost in the inventory, rounded to two places; nothing where that is unknown.
    """
    parts = _stored(customer_products(orders, returns), "customer-products")
    named = _segmented(parts, classes, segments).select("CustomerID", "Segment")
    cost = inventory.groupBy("ProductName").agg(F.round(F.avg("CostPrice"), 2).alias("Avg_Cost"))
    sums = [F.count(F.lit(1)).alias("Pairs"), F.sum("Orders").alias("Orders"), F.sum("Quantity").alias("Quantity"), *added_parts("revenue"), *added_parts("returned")]
    by_both = parts.join(named, "CustomerID").groupBy("ProductName", "Segment").agg(*sums).join(cost, "ProductName", "left")
    unit = F.col("Avg_Cost").try_cast("decimal(18,2)")
    by_both = by_both.withColumn("Cost", F.coalesce((F.col("Quantity").cast("decimal(18,0)") * unit).cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)")))
    names = [F.col("ProductName"), F.col("Segment")]
    level = F.element_at(F.array(*map(F.lit, ("product and segment", "product", "segment", "all"))), F.grouping_id().cast("int") + 1)
    totals = by_both.groupingSets([names, names[:1], names[1:], []], *names).agg(
        level.alias("Level"),
        F.sum("Pairs").alias("Customer_Products"),
        F.sum("Orders").alias("Orders"),
        *added_parts("revenue"),
        *added_parts("returned"),
        F.sum("Cost").cast("double").alias("Cost"),
    )
    revenue, returned = (F.coalesce(money_of(c), F.lit(0.0)) for c in ("revenue", "returned"))
    return totals.select(
        "Level", "ProductName", "Segment", "Customer_Products", "Orders",
        F.round(revenue, 2).alias("Revenue"), F.round(returned, 2).alias("Returned_Amount"), "Cost",
        F.round(revenue - returned - F.col("Cost"), 2).alias("Profit"),
    )
