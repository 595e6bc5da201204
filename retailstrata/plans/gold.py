"""Gold layer: the joined rows and the KPI tables built from silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_join
from ..operators.kpis import product_kpis
from ..operators.rows import quoted

RETURN_DETAILS = ("ReturnID", "ReturnReason", "ReturnDate", "RefundStatus", "PickupAddress", "ReturnAmount", "Product")
# What the numbers of a hot order's returns are drawn by: columns whose rules cost little, so that those of the others are
# worked out only where a result has them. Returns without an id still differ in customer and reason.
_DRAWN_BY = ("ReturnID", "CustomerID", "ReturnReason")


def orders_left_returns(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Every order once per matching return, or once without one; unambiguous column names."""
    select = [F.col(f"l.{quoted(c)}") for c in orders.columns]
    select += [F.col(f"r.{c}") for c in RETURN_DETAILS]
    select.append(F.col("r.CustomerID").alias("ReturnCustomerID"))
    return left_join(orders, returns, "OrderID", select, drawn_by=_DRAWN_BY)


def enriched_orders(orders: DataFrame, returns: DataFrame, inventory: DataFrame) -> DataFrame:
    """Order x return x inventory rows with the seven columns the KPIs are defined on."""
    returned = left_join(
        orders,
        returns,
        "OrderID",
        [
            F.col("l.ProductName"),
            F.col("l.OrderID"),
            F.col("l.CustomerID"),
            F.col("l.OrderAmount"),
            F.col("r.ReturnID"),
        ],
        drawn_by=_DRAWN_BY,
    )
    return left_join(
        returned,
        inventory,
        "ProductName",
        [F.col(f"l.{c}") for c in returned.columns] + [F.col("r.Stock"), F.col("r.CostPrice")],
    )


def gold_product_kpis(orders: DataFrame, returns: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per product, counted over the joined rows."""
    return product_kpis(orders, returns, inventory)


def gold_kpi_by_product_month(orders: DataFrame, returns: DataFrame, inventory: DataFrame) -> DataFrame:
    """As ``gold_product_kpis`` per product and month of the order (null month = no readable date)."""
    dated = orders.withColumn("Order_Month", F.trunc("OrderDate", "month"))
    return product_kpis(dated, returns, inventory, by=("ProductName", "Order_Month"))


def gold_kpi_no_fanout(orders: DataFrame, returns: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per product where each order, return and inventory row counts once."""
    return product_kpis(orders, returns, inventory, fan_out=False)
