"""Product KPIs over orders LEFT JOIN returns LEFT JOIN inventory.

The joined rows multiply: an order with k returns appears k times, and again m times for a product
with m inventory rows. They are never produced here. Returns are counted per order and inventory is
summed per product first, and the KPIs follow from these counts:

    joined rows of an order    = max(k, 1) * max(m, 1)
    sum(amount) per product    = m * sum(amount * k)
    sum(stock) per product     = sum(k) * (sum of the product's stock)
    avg(amount), avg(cost)     = the common factor m (or k) cancels

So every shuffle carries partial aggregates, both joins are on unique right-hand keys, and no key,
however frequent, gathers its rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .money import money
from .rows import quoted

KPI_COLUMNS = (
    "Total_Orders",
    "Unique_Customers",
    "Total_Returns",
    "Return_Rate_%",
    "Total_Revenue",
    "Avg_Order_Value",
    "Total_Stock",
    "Avg_Cost",
    "Net_Profit",
)


def _order_measures(orders: DataFrame, returns: DataFrame, by: Sequence[str], fan_out: bool) -> DataFrame:
    """Per group of orders: weighted counts and sums, the weight being the joined rows of the order."""
    per_order = returns.groupBy("OrderID").agg(
        F.count(F.lit(1)).alias("return_rows"), F.count("ReturnID").alias("return_ids")
    )
    weight = F.coalesce("return_rows", F.lit(1)) if fan_out else F.lit(1)
    rows = orders.join(per_order, "OrderID", "left").withColumn("weight", weight.cast("bigint"))
    return rows.groupBy(*map(quoted, by)).agg(
        F.sum(F.when(F.col("OrderID").isNotNull(), F.col("weight")).otherwise(0)).alias("order_rows"),
        F.count_distinct("CustomerID").alias("customers"),
        F.sum(F.coalesce("return_ids", F.lit(0))).alias("return_ids"),
        money(F.col("OrderAmount") * F.col("weight")).alias("amount"),
        F.sum(F.when(F.col("OrderAmount").isNotNull(), F.col("weight")).otherwise(0)).alias("amount_rows"),
        F.sum("weight").alias("weight"),
    )


def _stock_measures(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("ProductName").agg(
        F.count(F.lit(1)).alias("stock_rows"),
        F.sum("Stock").alias("stock"),
        F.avg("CostPrice").alias("avg_cost"),
    )


def product_kpis(
    orders: DataFrame,
    returns: DataFrame,
    inventory: DataFrame,
    by: Sequence[str] = ("ProductName",),
    fan_out: bool = True,
) -> DataFrame:
    """KPIs per group of order columns ``by``, which must include ``ProductName``.

    ``fan_out=True`` counts joined rows, as a plain join and aggregate would. ``fan_out=False`` counts
    every order, return and inventory row once.
    """
    if "ProductName" not in by:
        raise ValueError("product KPIs need ProductName among the grouping columns")
    groups = _order_measures(orders, returns, by, fan_out).join(
        _stock_measures(inventory), "ProductName", "left"
    )
    return kpis_of(groups, by, fan_out)


def kpis_of(groups: DataFrame, by: Sequence[str], fan_out: bool = True) -> DataFrame:
    """The KPIs from the measures of orders and stock of each group."""
    copies = F.coalesce("stock_rows", F.lit(1)) if fan_out else F.lit(1)
    order_rows = F.col("order_rows") * copies
    return_rows = F.col("return_ids") * copies
    revenue = F.col("amount") * copies
    stock = F.col("stock") * F.col("weight") if fan_out else F.col("stock")
    return groups.select(
        *map(quoted, by),
        order_rows.alias("Total_Orders"),
        F.col("customers").alias("Unique_Customers"),
        return_rows.alias("Total_Returns"),
        return_rate(return_rows, order_rows).alias("Return_Rate_%"),
        F.round(revenue, 2).alias("Total_Revenue"),
        F.round(F.try_divide("amount", "amount_rows"), 2).alias("Avg_Order_Value"),
        stock.alias("Total_Stock"),
        F.round("avg_cost", 2).alias("Avg_Cost"),
        F.round(revenue - stock * F.col("avg_cost"), 2).alias("Net_Profit"),
    )


def return_rate(returned: Column, ordered: Column) -> Column:
    """Percentage to two places; null when nothing was ordered."""
    return F.round(F.try_divide(returned, ordered) * 100, 2)
