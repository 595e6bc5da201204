"""Time the headline steps and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the
warm runs (default 3, the best counts; the first run of each step is the cold time).

The pipeline starts from extract files, so those are derived from the tables and written first,
untimed. Steps on silver tables read written silver tables, as a rerun of one layer does. Results go
to a no-op sink: every column is computed, nothing is collected. ``yardsticks`` times the plain way of
doing the same work on the same inputs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailstrata.functions import cleaning as clean
from retailstrata.operators import fuzzy, quality
from retailstrata.operators.rows import dedup
from retailstrata.plans import gold, insights, pipeline, segments, silver
from retailstrata.plans.incremental import KpiStates
from retailstrata.registry import frames, queries
from retailstrata.sources.extracts import promote_header
from retailstrata.sources.listed import ListedTable


def session(name: str, cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(build: Callable[[], DataFrame]) -> float:
    """Seconds to build the plan, with any job that takes, and to run it."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def joined_kpis(orders: DataFrame, returns: DataFrame, inventory: DataFrame) -> DataFrame:
    """The KPI table by producing and aggregating every joined row."""
    rows = orders.join(returns.select("OrderID", "ReturnID"), "OrderID", "left").join(
        inventory.select("ProductName", "Stock", "CostPrice"), "ProductName", "left"
    )
    return rows.groupBy("ProductName").agg(
        F.count("OrderID"),
        F.count_distinct("CustomerID"),
        F.count("ReturnID"),
        F.sum("OrderAmount"),
        F.avg("OrderAmount"),
        F.sum("Stock"),
        F.avg("CostPrice"),
    )


def layered(spark: SparkSession, folder: str, paths: list[str]) -> DataFrame:
    """All layers from extract files, in one database that every run overwrites."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bench LOCATION '{folder}/bench'")
    return pipeline.run_all(spark, *paths, layers=pipeline.Layers(database="bench", order_buckets=8))


def plain_left_returns(orders: DataFrame, returns: DataFrame) -> DataFrame:
    renamed = returns.withColumnsRenamed({"OrderID": "ReturnedOrderID", "CustomerID": "ReturnCustomerID"})
    return orders.join(renamed, F.col("OrderID") == F.col("ReturnedOrderID"), "left").drop("ReturnedOrderID")


def plain_enriched(orders: DataFrame, returns: DataFrame, inventory: DataFrame) -> DataFrame:
    both = orders.select("ProductName", "OrderID", "CustomerID", "OrderAmount").join(returns.select("OrderID", "ReturnID"), "OrderID", "left")
    return both.join(inventory.select("ProductName", "Stock", "CostPrice"), "ProductName", "left")


def plain_segments(orders: DataFrame) -> DataFrame:
    """Recency, frequency and value classes by windows over all customers."""
    customers = orders.groupBy("CustomerID").agg(F.max("OrderDate").alias("last"), F.count("OrderID").alias("n"), F.sum("OrderAmount").alias("v"))
    return customers.select("*", *[F.ntile(5).over(Window.orderBy(c, "CustomerID")).alias(f"class_{c}") for c in ("last", "n", "v")])


def changed(orders: DataFrame, run: int) -> DataFrame:
    """One of a hundred orders, of the last months, with another amount in every run."""
    late = F.col("OrderDate") >= "2001-01-01"
    return orders.where(late & (F.crc32("OrderID") % 10 == 0)).withColumn("OrderAmount", F.lit(float(run))).withColumn("Order_Month", F.trunc("OrderDate", "month"))


def merged(table: ListedTable, orders: DataFrame, run: int) -> DataFrame:
    table.merge(changed(orders, run))
    return orders.limit(0)


def rewritten(table: ListedTable, orders: DataFrame, run: int, folder: str) -> DataFrame:
    """The plain way to merge: all rows written again."""
    changes = changed(orders, run)
    rows = table.read().join(changes.select("OrderID"), "OrderID", "left_anti").unionByName(changes)
    rows.write.mode("overwrite").partitionBy("Order_Month").parquet(f"{folder}/rewritten")
    return orders.limit(0)


def added(states: KpiStates, orders: DataFrame, returns: DataFrame, run: int) -> DataFrame:
    """A load of one order and one return of a hundred, and the gold table after it."""
    states.add(f"run {run}", orders.where(F.crc32("OrderID") % 100 == run % 100), returns.where(F.crc32("OrderID") % 100 == run % 100))
    return states.kpis()


def steps(spark: SparkSession, sf_dir: str, folder: str) -> tuple[dict, dict]:
    cores = spark.sparkContext.defaultParallelism
    orders, returns, inventory = (
        stored(derive(spark, sf_dir).repartition(cores), f"{folder}/{derive.__name__}")
        for derive in (frames.raw_orders, frames.raw_returns, frames.raw_inventory)
    )
    silver_tables = [
        stored(clean_table(raw), f"{folder}/{clean_table.__name__}")
        for clean_table, raw in (
            (silver.silver_orders, orders),
            (silver.silver_returns, returns),
            (silver.silver_inventory, inventory),
        )
    ]
    named = silver.rename_orders(orders)
    headed = f"{folder}/headed_returns"
    queries.with_header_row(returns).write.parquet(headed)
    runs = count(1)
    orders_table = ListedTable(spark, f"{folder}/listed", "OrderID", ("Order_Month",))
    orders_table.create(silver_tables[0].withColumn("Order_Month", F.trunc("OrderDate", "month")))
    states = KpiStates(spark, f"{folder}/states")
    states.add("first", *silver_tables)
    timed: dict[str, Callable[[], DataFrame]] = {
        "silver_orders": lambda: silver.silver_orders(orders),
        "silver_returns": lambda: silver.silver_returns(returns),
        "silver_inventory": lambda: silver.silver_inventory(inventory),
        "dedup_orders": lambda: dedup(named, ["OrderID"]),
        "clean_order_date": lambda: named.select(clean.clean_order_date(F.col("OrderDate"))),
        "clean_delivery_status": lambda: named.select(clean.clean_delivery_status(F.col("DeliveryStatus"))),
        "clean_product": lambda: returns.select(clean.clean_product(F.col("Product"))),
        "orders_left_returns": lambda: gold.orders_left_returns(*silver_tables[:2]),
        "qualified_projection": lambda: gold.enriched_orders(*silver_tables),
        "gold_product_kpis": lambda: gold.gold_product_kpis(*silver_tables),
        "gold_kpi_by_product_month": lambda: gold.gold_kpi_by_product_month(*silver_tables),
        "gold_kpi_no_fanout": lambda: gold.gold_kpi_no_fanout(*silver_tables),
        "check_returns": lambda: quality.violations(
            quality.with_order_date(silver_tables[1], silver_tables[0]), quality.return_checks(queries.CHECK_DATE)
        ),
        "customer_value": lambda: insights.customer_value(*silver_tables[:2]),
        "product_month_trend": lambda: insights.product_month_trend(silver_tables[0]),
        "product_calendar": lambda: insights.product_calendar(silver_tables[0]),
        "customer_segments": lambda: segments.customer_segments(*silver_tables[:2]),
        "segment_profit": lambda: segments.segment_profit(*silver_tables),
        "similar_products": lambda: fuzzy.similar_texts(silver_tables[2], "ProductName", 1),
        "merge_orders": lambda: merged(orders_table, silver_tables[0], next(runs)),
        "incremental_kpis": lambda: added(states, *silver_tables[:2], next(runs)),
        "promote_header": lambda: promote_header(spark, headed),
        "layered_pipeline": lambda: layered(spark, folder, [f"{folder}/raw_orders", headed, f"{folder}/raw_inventory"]),
        "raw_to_gold": lambda: gold.gold_product_kpis(
            silver.silver_orders(orders), silver.silver_returns(returns), silver.silver_inventory(inventory)
        ),
    }
    yardsticks: dict[str, Callable[[], DataFrame]] = {
        "dedup_orders": lambda: named.dropDuplicates(["OrderID"]),
        "clean_order_date": lambda: named.select(
            F.coalesce(*[F.try_to_date("OrderDate", fmt) for fmt in clean.ORDER_DATE_FORMATS])
        ),
        "clean_delivery_status": lambda: named.select(F.lower(F.regexp_replace("DeliveryStatus", "[^a-zA-Z ]", ""))),
        "clean_product": lambda: returns.select(
            F.initcap(F.trim(F.regexp_replace("Product", r"[^a-zA-Z0-9\s]", "")))
        ),
        "gold_product_kpis": lambda: joined_kpis(*silver_tables),
        "orders_left_returns": lambda: plain_left_returns(*silver_tables[:2]),
        "qualified_projection": lambda: plain_enriched(*silver_tables),
        "customer_segments": lambda: plain_segments(silver_tables[0]),
        "merge_orders": lambda: rewritten(orders_table, silver_tables[0], next(runs), folder),
        "incremental_kpis": lambda: gold.gold_product_kpis(*silver_tables),
    }
    return timed, yardsticks


def measure(timed: dict, runs: int) -> tuple[dict, dict]:
    cold, warm = {}, {}
    for name, build in timed.items():
        cold[name] = round(run(build), 3)
        warm[name] = round(min(run(build) for _ in range(runs)), 3)
    return cold, warm


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session("bench", cpus)
    timed, yardsticks = steps(spark, sf_dir, tempfile.mkdtemp(prefix="retailstrata-bench-"))
    cold, warm = measure(timed, runs)
    plain = measure(yardsticks, runs)[1]
    result = {
        "metric": "headline_steps_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cold": cold,
        "yardsticks": plain,
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
