"""The whole run: raw files to bronze, silver and gold tables.

Layers hand over through tables, so each one can be rerun alone and an executor loss never reaches
back further than the last written layer. Corrections and checks of the returns and a copy of the orders by
month are steps to be asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import fix_customer_prefix
from ..operators import quality
from ..operators.rows import dedup, quoted
from ..sources import schemas
from ..sources.extracts import promote_header, read_extract
from ..sources.tables import DEFAULT_FORMAT, drop_if, gathered, read_table, replace_partitions, write_table
from .gold import gold_product_kpis
from .silver import silver_inventory, silver_orders, silver_returns

GOLD_TABLE = "gold_product_month_kpis"
CHECKS_TABLE = "returns_checks"
JUDGED_TABLE = "returns_judged"
REJECTED_TABLE = "returns_rejected"
MONTHLY_TABLE = "silver_orders_by_month"
MONTH = "Order_Month"


@dataclass(frozen=True)
class Layers:
    """Table naming and storage of one run.

    ``database`` qualifies every table name. ``order_buckets`` stores silver orders, the largest table,
    bucketed by OrderID: the gold join then shuffles only the per-order counts of returns. OrderIDs are
    unique there, so the buckets are even; returns are not, and stay unbucketed. The number should be
    that of the shuffle partitions of the run, so that each write task fills whole buckets.

    ``fix_prefixes`` puts misspelled customer ids right, ``dedup_returns`` keeps one row per ReturnID, both on
    the way to silver. ``checked_on`` writes how many returns break which check as of that date. With ``set_aside``
    those that break one are moved from silver returns to a table of their own, with the reasons; the checks are
    then counted while both are written.
    ``orders_by_month`` keeps silver orders also by month (null for undated ones); a later run replaces
    only the months it brings.
    """

    fmt: str = DEFAULT_FORMAT
    database: str | None = None
    order_buckets: int | None = None
    fix_prefixes: bool = False
    dedup_returns: bool = False
    checked_on: dt.date | None = None
    set_aside: bool = False
    orders_by_month: bool = False

    def name(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else table

    def write(self, df: DataFrame, table: str) -> None:
        buckets = self.order_buckets if table == "silver_orders" else None
        write_table(df, self.name(table), self.fmt, buckets=buckets, bucket_by="OrderID")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.name(table))


def run_bronze(
    spark: SparkSession, orders_path: str, returns_path: str, inventory_path: str, layers: Layers = Layers()
) -> None:
    """Store the extracts as they are; the returns extract carries its header in the data."""
    returns = schemas.check_schema(promote_header(spark, returns_path), schemas.RAW_RETURNS, returns_path)
    layers.write(read_extract(spark, orders_path, schemas.RAW_ORDERS), "bronze_orders")
    layers.write(returns, "bronze_returns")
    layers.write(read_extract(spark, inventory_path, schemas.RAW_INVENTORY), "bronze_inventory")


SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": silver_orders,
    "returns": silver_returns,
    "inventory": silver_inventory,
}


def _corrected(df: DataFrame, table: str, layers: Layers) -> DataFrame:
    if layers.fix_prefixes and "CustomerID" in df.columns:
        df = df.withColumn("CustomerID", fix_customer_prefix(F.col("CustomerID")))
    return dedup(df, ["ReturnID"]) if layers.dedup_returns and table == "returns" else df


def run_silver(spark: SparkSession, layers: Layers = Layers()) -> None:
    for table, clean in SILVER.items():
        df = _corrected(clean(layers.read(spark, f"bronze_{table}")), table, layers)
        if table == "returns" and layers.set_aside:
            write_judged(spark, df, layers)
        else:
            drop_if(spark, layers.name(f"silver_{table}"), view=True)
            layers.write(df, f"silver_{table}")


def write_judged(spark: SparkSession, returns: DataFrame, layers: Layers) -> None:
    """Judge cleaned returns once: to one table by verdict, of which silver returns and the rejected ones are parts.

    The silver orders must be there.
    """
    if layers.checked_on is None:
        raise ValueError("returns are set aside as of a day: checked_on")
    counts = Observation()
    checks = quality.return_checks(layers.checked_on)
    dated = quality.with_order_date(returns, layers.read(spark, "silver_orders"))
    rows = quality.judged(dated, checks, counts).select(*map(quoted, returns.columns), "Reject_Reasons", "Rejected")
    write_table(rows, layers.name(JUDGED_TABLE), layers.fmt, partition_by=["Rejected"])
    # Both read one partition of it.
    for name, rejected in (("silver_returns", False), (REJECTED_TABLE, True)):
        drop_if(spark, layers.name(name), view=False)
        columns = list(returns.columns) + ["Reject_Reasons"] * rejected
        text = ", ".join(map(quoted, columns))
        spark.sql(f"CREATE OR REPLACE VIEW {layers.name(name)} AS SELECT {text} FROM {layers.name(JUDGED_TABLE)} WHERE Rejected = {str(rejected).lower()}")
    found = counts.get
    names = ["Rows", *checks, "Rejected"]
    layers.write(spark.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"{n} bigint" for n in names)), CHECKS_TABLE)


def run_checks(spark: SparkSession, layers: Layers) -> None:
    """Count the returns that break a check; ``layers.checked_on`` is the day they are judged from."""
    dated = quality.with_order_date(layers.read(spark, "silver_returns"), layers.read(spark, "silver_orders"))
    layers.write(quality.violations(dated, quality.return_checks(layers.checked_on)), CHECKS_TABLE)


def run_monthly(spark: SparkSession, layers: Layers) -> None:
    """Store silver orders by month, or replace the months that these orders have."""
    orders = layers.read(spark, "silver_orders").withColumn(MONTH, F.trunc("OrderDate", "month"))
    rows, name = gathered(orders, [MONTH], ["ProductName"]), layers.name(MONTHLY_TABLE)
    if spark.catalog.tableExists(name):
        replace_partitions(rows, name)
    else:
        write_table(rows, name, layers.fmt, partition_by=[MONTH])


def run_gold(spark: SparkSession, layers: Layers = Layers()) -> None:
    silver = [layers.read(spark, f"silver_{table}") for table in ("orders", "returns", "inventory")]
    layers.write(gold_product_kpis(*silver), GOLD_TABLE)


def run_all(
    spark: SparkSession, orders_path: str, returns_path: str, inventory_path: str, layers: Layers = Layers()
) -> DataFrame:
    """Run the three layers and return the gold table."""
    run_bronze(spark, orders_path, returns_path, inventory_path, layers)
    run_silver(spark, layers)
    if layers.checked_on is not None and not layers.set_aside:
        run_checks(spark, layers)
    if layers.orders_by_month:
        run_monthly(spark, layers)
    run_gold(spark, layers)
    return layers.read(spark, GOLD_TABLE)
