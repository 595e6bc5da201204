"""Further reports on silver tables: trends, return reasons, customer value, stock turnover.

Each one aggregates to the grain of its report before it joins or opens a window, so what is
shuffled or sorted is one row per report line and order rows are never multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.money import money


def product_month_trend(orders: DataFrame, months: int = 3) -> DataFrame:
    """Revenue per product and month, its change and its mean over the last ``months`` rows.

    Orders without a readable date are a row of their own with a null month, change and mean.
    """
    monthly = orders.groupBy("ProductName", F.trunc("OrderDate", "month").alias("Order_Month")).agg(
        money(F.col("OrderAmount")).alias("Revenue")
    )
    dated = F.col("Order_Month").isNotNull()
    by_month = Window.partitionBy("ProductName", dated).orderBy("Order_Month")
    previous = F.lag("Revenue").over(by_month)
    return monthly.select(
        "ProductName",
        "Order_Month",
        F.year("Order_Month").alias("Order_Year"),
        F.month("Order_Month").alias("Month_Of_Year"),
        "Revenue",
        (F.col("Revenue") - previous).alias("Revenue_Change"),
        F.when(dated, F.round(F.avg("Revenue").over(by_month.rowsBetween(1 - months, 0)), 2)).alias("Rolling_Revenue"),
    )


def return_reasons(returns: DataFrame) -> DataFrame:
    """Returns and returned amount per reason."""
    totals = returns.groupBy("ReturnReason").agg(
        F.count(F.lit(1)).alias("Returns"),
        F.count("ReturnAmount").alias("Priced_Returns"),
        money(F.col("ReturnAmount")).alias("Returned_Amount"),
    )
    mean = F.try_divide("Returned_Amount", "Priced_Returns")
    return totals.withColumn("Avg_Returned_Amount", F.round(mean, 2))


def customer_value(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Orders, revenue and revenue less returned amounts per customer."""
    returned = returns.groupBy("OrderID").agg(money(F.col("ReturnAmount")).alias("returned"))
    return (
        orders.select("OrderID", "CustomerID", "OrderAmount")
        .join(returned, "OrderID", "left")
        .groupBy("CustomerID")
        .agg(
            F.count("OrderID").alias("Orders"),
            money(F.col("OrderAmount")).alias("Revenue"),
            F.coalesce(money(F.col("returned")), F.lit(0.0)).alias("Returned_Amount"),
        )
        .withColumn("Lifetime_Value", F.round(F.col("Revenue") - F.col("Returned_Amount"), 2))
    )


def inventory_turnover(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Units sold per unit in stock, per product; null without stock."""
    sold = orders.groupBy("ProductName").agg(F.sum("Quantity").alias("Units_Sold"))
    stock = inventory.groupBy("ProductName").agg(F.sum("Stock").alias("Units_In_Stock"))
    turnover = F.round(F.try_divide("Units_Sold", "Units_In_Stock"), 2)
    return sold.join(stock, "ProductName", "left").withColumn("Turnover", turnover)


def product_calendar(orders: DataFrame, months: int = 3) -> DataFrame:
    """Orders and revenue per product for every month from its first to its last order, months without any as zero.

    ``Revenue_Change`` and ``Revenue_Year_Before`` are against the month before and the same month a year before, null
    before the product's first month. ``Rolling_Revenue`` is the mean of the last ``months`` months since then. Frames
    go by the calendar, not by rows. Orders without a readable date have no month and are left out.
    """
    monthly = orders.where("OrderDate is not null").groupBy("ProductName", F.trunc("OrderDate", "month").alias("Order_Month")).agg(
        F.count(F.lit(1)).alias("Orders"), money(F.col("OrderAmount")).alias("Revenue")
    )
    span = monthly.groupBy("ProductName").agg(F.min("Order_Month").alias("lo"), F.max("Order_Month").alias("hi"))
    every = F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("Order_Month")
    spine = span.select("ProductName", every, F.lit(0).cast("bigint").alias("Orders"), F.lit(0.0).alias("Revenue"))
    dense = monthly.unionByName(spine).groupBy("ProductName", "Order_Month").agg(
        F.sum("Orders").alias("Orders"), F.sum(F.coalesce("Revenue", F.lit(0.0))).alias("Revenue")
    )
    number = (F.year("Order_Month") * 12 + F.month("Order_Month")).cast("bigint")
    by_month = Window.partitionBy("ProductName").orderBy(number)

    def earlier(n: int):
        return F.first("Revenue").over(by_month.rangeBetween(-n, -n))

    return dense.select(
        "ProductName",
        "Order_Month",
        "Orders",
        "Revenue",
        F.round(F.col("Revenue") - earlier(1), 2).alias("Revenue_Change"),
        F.round(F.avg("Revenue").over(by_month.rangeBetween(1 - months, 0)), 2).alias("Rolling_Revenue"),
        earlier(12).alias("Revenue_Year_Before"),
    )


def product_trend(orders: DataFrame) -> DataFrame:
    """Per product the straight line through its monthly revenue, months without orders being zero.

    ``Monthly_Growth`` is the slope in revenue a month, ``Fit`` the share of the variation the line explains; null
    for a single month. ``Best_Year_Change`` is the largest gain on the same month a year before, null without one.
    """
    calendar = product_calendar(orders)
    month = (F.year("Order_Month") * 12 + F.month("Order_Month")).cast("double")
    several = F.count(F.lit(1)) > 1
    return calendar.groupBy("ProductName").agg(
        F.count(F.lit(1)).alias("Months"),
        F.round(F.when(several, F.regr_slope(F.col("Revenue"), month)), 2).alias("Monthly_Growth"),
        F.round(F.when(several, F.regr_r2(F.col("Revenue"), month)), 6).alias("Fit"),
        F.round(F.max(F.col("Revenue") - F.col("Revenue_Year_Before")), 2).alias("Best_Year_Change"),
    )
