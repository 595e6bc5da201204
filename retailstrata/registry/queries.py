"""The registered queries: each takes (spark, folder of benchmark tables) and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as clean
from ..operators import fuzzy, lookups, quality, rows
from ..operators.joins import left_join
from ..plans import gold, insights, pipeline, segments, silver
from ..plans.incremental import KpiStates
from ..sources import schemas, tables
from ..sources.extracts import promote_header, read_extract, read_mixed_extract
from ..sources.listed import ListedTable
from ..sources.scratch import release, shared_folder, smaller_tasks
from .frames import raw_inventory, raw_orders, raw_returns

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs ---------------------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, *needed: str) -> DataFrame:
    """Silver orders, or their columns up to the last ``needed`` one."""
    return silver.silver_orders(raw_orders(spark, sf_dir), needed or None)


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_returns(raw_returns(spark, sf_dir))


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_inventory(raw_inventory(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, *needed: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _orders(spark, sf_dir, *needed), _returns(spark, sf_dir), _inventory(spark, sf_dir)


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid4().hex}"


def with_header_row(df: DataFrame) -> DataFrame:
    """Positional column names, the real ones as the first row of the first partition."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    header = df.sparkSession.range(0, 1, 1, 1).select(*[F.lit(c).alias(n) for c, n in zip(df.columns, names)])
    return header.union(df.toDF(*names))


# --- sources and sinks ----------------------------------------------------------------------------


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark)
    raw_orders(spark, sf_dir).write.parquet(path)
    return read_extract(spark, path, schemas.RAW_ORDERS)


def promoted_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark)
    with_header_row(raw_returns(spark, sf_dir)).write.parquet(path)
    return schemas.check_schema(promote_header(spark, path), schemas.RAW_RETURNS)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark)
    name = f"silver_returns_{path[-8:]}"
    tables.write_table(_returns(spark, sf_dir), name, path=path)
    table = tables.read_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows them
    return table


def _layered(spark: SparkSession, sf_dir: str, table: str, returns: Query = raw_returns, **steps) -> DataFrame:
    """Extract files to bronze, silver and gold tables, in a database that is dropped after ``table`` was copied."""
    folder = _new_folder(spark)
    database = f"retail_{folder[-8:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    extracts = {
        "orders": raw_orders(spark, sf_dir),
        "returns": with_header_row(returns(spark, sf_dir)),
        "inventory": raw_inventory(spark, sf_dir),
    }
    for name, df in extracts.items():
        df.write.parquet(f"{folder}/{name}", compression=tables.COMPRESSION["parquet"])
    layers = pipeline.Layers(database=database, **steps)
    pipeline.run_all(spark, *[f"{folder}/{name}" for name in extracts], layers=layers)
    layers.read(spark, table).write.parquet(f"{folder}/result")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.parquet(f"{folder}/result")


def layered_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layered(spark, sf_dir, pipeline.GOLD_TABLE)


def bucketed_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table over silver orders stored in buckets."""
    return _layered(spark, sf_dir, pipeline.GOLD_TABLE, order_buckets=8)


def checked_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returns checks of a run with every step that can be asked for."""
    return _layered(
        spark, sf_dir, pipeline.CHECKS_TABLE,
        order_buckets=8, fix_prefixes=True, dedup_returns=True, checked_on=CHECK_DATE, orders_by_month=True,
    )


def misspelled_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw returns of which two of three have a misspelled customer prefix."""
    number = F.substr(F.trim("Customer_ID"), F.lit(5))
    prefix = F.element_at(F.array(F.lit("CUST"), F.lit("CST"), F.lit("CT")), number.cast("int") % 3 + 1)
    return raw_returns(spark, sf_dir).withColumn("Customer_ID", F.concat(prefix, number))


def corrected_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver returns of a run that puts misspelled customer ids right and keeps one row per ReturnID."""
    return _layered(spark, sf_dir, "silver_returns", misspelled_returns, fix_prefixes=True, dedup_returns=True)


def rejected_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns that a run has set aside, with their reasons."""
    found = _layered(spark, sf_dir, pipeline.REJECTED_TABLE, checked_on=CHECK_DATE, set_aside=True)
    return found.withColumn("Reject_Reasons", F.array_join("Reject_Reasons", ","))


def judged_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table over the accepted returns."""
    return _layered(spark, sf_dir, pipeline.GOLD_TABLE, checked_on=CHECK_DATE, set_aside=True)


def typed_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver inventory of an extract file with numbers in numeric columns."""
    path = _new_folder(spark)
    raw = raw_inventory(spark, sf_dir)
    numbers = {"stock": F.col("stock").try_cast("int"), "cost_price": F.regexp_extract("cost_price", "[0-9.]+", 0).try_cast("double")}
    raw.withColumns(numbers).write.parquet(path)
    return silver.silver_inventory(read_extract(spark, path, schemas.RAW_INVENTORY))


def mixed_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver inventory of an extract with three kinds of files: texts, numbers in numeric columns, other names and order."""
    path = _new_folder(spark)
    raw, kind = raw_inventory(spark, sf_dir), F.char_length("productName") % 3
    stock, cost = F.col("stock").try_cast("int"), F.regexp_extract("cost_price", "[0-9.]+", 0).try_cast("double")
    raw.where(kind == 0).write.parquet(path)
    raw.where(kind == 1).withColumns({"stock": stock, "cost_price": cost}).write.mode("append").parquet(path)
    other = raw.where(kind == 2).withColumns({"stock": stock.cast("double"), "note": F.lit(1)})
    other.select("note", *[F.col(c).alias(c.upper()) for c in reversed(raw.columns)]).write.mode("append").parquet(path)
    return silver.silver_inventory(read_mixed_extract(spark, path, schemas.RAW_INVENTORY))


def unknown_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unknown_statuses(_returns(spark, sf_dir))


# --- cleaning rules -------------------------------------------------------------------------------


def _rule(raw: Query, key: str, column: str, rule: Callable, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        value = F.col(rows.quoted(column))
        return raw(spark, sf_dir).select(key, value.alias("raw_value"), rule(value).alias(name))

    return query


RULES: dict[str, Query] = {
    "clean_quantity": _rule(raw_orders, "Order_ID", "Qty", clean.clean_quantity, "Quantity"),
    "clean_order_date": _rule(raw_orders, "Order_ID", "Order_Date", clean.clean_order_date, "OrderDate"),
    "clean_amount": _rule(raw_orders, "Order_ID", "Order_Amount$", clean.clean_amount, "OrderAmount"),
    "clean_payment_mode": _rule(raw_orders, "Order_ID", "Payment_Mode", clean.clean_payment_mode, "PaymentMode"),
    "clean_delivery_status": _rule(
        raw_orders, "Order_ID", "Delivery_Status", clean.clean_delivery_status, "DeliveryStatus"
    ),
    "validate_email": _rule(raw_orders, "Order_ID", "Email", clean.valid_email, "Email"),
    "clean_ship_address": _rule(raw_orders, "Order_ID", "Ship_Address", clean.clean_ship_address, "ShipAddress"),
    "clean_feedback": _rule(raw_orders, "Order_ID", "Feedback_Score", clean.clean_feedback_score, "FeedbackScore"),
    "clean_stock": _rule(raw_inventory, "productName", "stock", clean.clean_stock, "Stock"),
    "clean_last_stocked": _rule(
        raw_inventory, "productName", "last_stocked", clean.clean_last_stocked, "LastStocked"
    ),
    "clean_cost_price": _rule(raw_inventory, "productName", "cost_price", clean.clean_cost_price, "CostPrice"),
    "clean_warehouse": _rule(raw_inventory, "productName", "warehouse", clean.clean_warehouse, "Warehouse"),
    "clean_available": _rule(raw_inventory, "productName", "available", clean.clean_available, "Available"),
    "clean_return_date": _rule(raw_returns, "Return_ID", "Return_Date", clean.clean_return_date, "ReturnDate"),
    "clean_refund_status": _rule(
        raw_returns, "Return_ID", "Refund_Status", clean.clean_refund_status, "RefundStatus"
    ),
    "clean_return_amount": _rule(
        raw_returns, "Return_ID", "Return_Amount", clean.clean_return_amount, "ReturnAmount"
    ),
    "clean_pickup_address": _rule(
        raw_returns, "Return_ID", "Pickup_Address", clean.clean_pickup_address, "PickupAddress"
    ),
    "clean_product": _rule(raw_returns, "Return_ID", "Product", clean.clean_product, "Product"),
    "clean_customer_id": _rule(raw_returns, "Return_ID", "Customer_ID", clean.clean_customer_id, "CustomerID"),
    "clean_amount_documented": _rule(
        raw_orders, "Order_ID", "Order_Amount$", clean.clean_amount_documented, "OrderAmount"
    ),
    "clean_delivery_status_documented": _rule(
        raw_orders, "Order_ID", "Delivery_Status", clean.clean_delivery_status_documented, "DeliveryStatus"
    ),
    "clean_product_documented": _rule(
        raw_returns, "Return_ID", "Product", clean.clean_product_documented, "Product"
    ),
    "clean_stock_documented": _rule(
        raw_inventory, "productName", "stock", clean.clean_stock_documented, "Stock"
    ),
}


# --- rows -----------------------------------------------------------------------------------------


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.preview(_inventory(spark, sf_dir), 5, ["ProductName", "Warehouse"])


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rename_orders(raw_orders(spark, sf_dir))


def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = silver.cleaned_orders(raw_orders(spark, sf_dir))
    return rows.fill_nulls(cleaned, silver.ORDER_DEFAULTS).select("OrderID", *silver.ORDER_DEFAULTS)


def drop_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = silver.rename_orders(raw_orders(spark, sf_dir))
    return rows.drop_missing(renamed, silver.ORDER_REQUIRED).select("OrderID", *silver.ORDER_REQUIRED)


def dedup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.dedup(silver.rename_orders(raw_orders(spark, sf_dir)), ["OrderID"])


# --- joins ----------------------------------------------------------------------------------------


def orders_left_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.orders_left_returns(_orders(spark, sf_dir), _returns(spark, sf_dir))


def enriched_left_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = gold.orders_left_returns(_orders(spark, sf_dir, "ProductName"), _returns(spark, sf_dir)).select("OrderID", "ProductName", "ReturnID")
    inventory = _inventory(spark, sf_dir)
    select = [F.col(f"l.{c}") for c in returned.columns]
    select += [F.col(f"r.{c}") for c in inventory.columns if c != "ProductName"]
    return left_join(returned, inventory, "ProductName", select)


def qualified_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.enriched_orders(*_silver(spark, sf_dir, "CustomerID", "ProductName", "OrderAmount"))


# --- aggregates -----------------------------------------------------------------------------------


def _gold(plan: Callable[..., DataFrame], *columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        kpis = plan(*_silver(spark, sf_dir, "CustomerID", "ProductName", "OrderDate", "OrderAmount"))
        return kpis.select("ProductName", *map(rows.quoted, columns)) if columns else kpis

    return query


# --- checks and further reports -------------------------------------------------------------------

CHECK_DATE = dt.date(1999, 12, 31)
KNOWN_REASONS = ("Damaged", "Late")
STATUS_NAMES = {"inprogress": "in progress", "failed": "rejected"}


def _dated_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_order_date(_returns(spark, sf_dir), _orders(spark, sf_dir, "OrderDate"))


def check_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(_dated_returns(spark, sf_dir), quality.return_checks(CHECK_DATE))


def unknown_return_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outside_list(_returns(spark, sf_dir), "ReturnReason", KNOWN_REASONS)


def map_refund_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = quality.map_values(F.col("RefundStatus"), STATUS_NAMES)
    return _returns(spark, sf_dir).select("ReturnID", "RefundStatus", mapped.alias("StandardStatus"))


def fix_customer_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer ids of the returns, two of three with a misspelled prefix, put right again."""
    number = F.substr("CustomerID", F.lit(5))
    prefix = F.element_at(F.array(F.lit("CUST"), F.lit("CST"), F.lit("CT")), number.cast("int") % 3 + 1)
    misspelled = _returns(spark, sf_dir).select("ReturnID", F.concat(prefix, number).alias("raw_value"))
    return misspelled.withColumn("CustomerID", clean.fix_customer_prefix(F.col("raw_value")))


def dedup_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.dedup(_returns(spark, sf_dir), ["ReturnID"])


def return_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated_returns(spark, sf_dir).select(
        "ReturnID",
        "OrderID",
        quality.days_to_return().alias("Days_To_Return"),
        quality.high_value().alias("High_Value"),
    )


def product_month_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.product_month_trend(_orders(spark, sf_dir, "ProductName", "OrderDate", "OrderAmount"))


def return_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.return_reasons(_returns(spark, sf_dir))


def customer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.customer_value(_orders(spark, sf_dir, "CustomerID", "OrderAmount"), _returns(spark, sf_dir))


def inventory_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.inventory_turnover(_orders(spark, sf_dir, "ProductName", "Quantity"), _inventory(spark, sf_dir))


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.customer_segments(_orders(spark, sf_dir, "CustomerID", "ProductName", "Quantity", "OrderDate", "OrderAmount"), _returns(spark, sf_dir))


def segment_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_profit(*_silver(spark, sf_dir, "CustomerID", "ProductName", "Quantity", "OrderDate", "OrderAmount"))


def product_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.product_calendar(_orders(spark, sf_dir, "ProductName", "OrderDate", "OrderAmount"))


def product_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.product_trend(_orders(spark, sf_dir, "ProductName", "OrderDate", "OrderAmount"))


# --- loads ----------------------------------------------------------------------------------------


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = _new_folder(spark)
    with smaller_tasks(spark):
        df.write.parquet(path, compression=tables.COMPRESSION["parquet"])
    release(spark)
    return spark.read.parquet(path)


def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three orders stored by month, then changes merged twice: the third ones new, some changed, some late."""
    orders = _stored(spark, _orders(spark, sf_dir))
    kind = F.col("Quantity") % 3
    month = F.trunc("OrderDate", "month")
    first = orders.where(kind != 0).withColumns({"Version": F.lit(2), "Order_Month": month})
    amount = F.col("OrderAmount") + F.when(kind == 1, 1.0).when(kind == 2, -1.0).otherwise(0.0)
    moved = F.when(kind == 1, F.date_add("OrderDate", 40)).otherwise(F.col("OrderDate"))
    version = F.when(kind == 1, 3).otherwise(1)
    changes = orders.withColumns({"OrderAmount": amount, "OrderDate": moved, "Version": version}).withColumn("Order_Month", month)
    table = ListedTable(spark, _new_folder(spark), "OrderID", ("Order_Month",))
    table.create(first, "Version")
    for _ in range(2):
        table.merge(changes, "Version")
    return table.read()


def clustered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one product, and all orders of one month, each from the files that may hold some, of a clustered table."""
    orders = _orders(spark, sf_dir, "OrderAmount").select("OrderID", "ProductName", "OrderDate", "OrderAmount")
    table = ListedTable(spark, _new_folder(spark), "OrderID", cluster_by=("ProductName", "OrderDate"), files_each=32)
    table.create(orders)
    of_product = table.read_between("ProductName", "hot product", "hot product").withColumn("Asked", F.lit("product"))
    of_month = table.read_between("OrderDate", dt.date(1996, 3, 1), dt.date(1996, 3, 31)).withColumn("Asked", F.lit("month"))
    return of_product.unionByName(of_month)


def incremental_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold KPIs of three loads: part of the orders, returns and inventory; the rest, with returns of earlier orders and
    orders that moved to another customer and product; and the second one again."""
    used = ("OrderID", "CustomerID", "ProductName", "Quantity", "OrderAmount"), ("OrderID", "ReturnID", "ReturnReason"), ("ProductName", "Stock", "CostPrice", "Available")
    cleaned = _silver(spark, sf_dir, *used[0][1:])
    orders, returns, inventory = (_stored(spark, df.select(*columns)) for df, columns in zip(cleaned, used))
    moved = F.col("Quantity") % 6 == 1
    later = orders.withColumns({
        "OrderAmount": F.when(moved, F.col("OrderAmount") + 1).otherwise(F.col("OrderAmount")),
        "CustomerID": F.when(moved, F.concat("CustomerID", F.lit("x"))).otherwise(F.col("CustomerID")),
        "ProductName": F.when(moved, F.lit("hot product")).otherwise(F.col("ProductName")),
    })
    late, here = F.col("ReturnReason") == "Late", F.coalesce(F.col("Available"), F.lit(False))
    loads = {
        "first": (orders.where("Quantity % 3 <> 0"), returns.where(~late), inventory.where(here)),
        "second": (later.where((F.col("Quantity") % 3 == 0) | moved), returns.where(late), inventory.where(~here)),
    }
    states = KpiStates(spark, _new_folder(spark))
    for name in ("first", "second", "second"):
        states.add(name, *loads[name])
    return states.kpis()


# --- misspelled names, mapping tables --------------------------------------------------------------


def similar_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names of the inventory within two edits of each other."""
    return fuzzy.similar_texts(_inventory(spark, sf_dir), "ProductName", 2)


def match_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest known name of each product name of the orders, two of five of which are misspelled."""
    name, kind = F.col("ProductName"), F.col("Quantity") % 5
    without = F.concat(F.substring(name, 1, 2), F.substr(name, F.lit(4)))
    more = F.concat(F.substring(name, 1, 3), F.lit("x"), F.substr(name, F.lit(4)))
    typed = _orders(spark, sf_dir, "ProductName", "Quantity").select(F.when(kind == 0, without).when(kind == 1, more).otherwise(name).alias("ProductName"))
    return fuzzy.nearest_known(typed, "ProductName", _inventory(spark, sf_dir).select("ProductName"), 1)


def _status_table(spark: SparkSession) -> DataFrame:
    return _stored(spark, spark.createDataFrame([*STATUS_NAMES.items()], "status string, standard string"))


def map_status_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refund statuses in standard form by a stored table."""
    mapped = lookups.mapped(_returns(spark, sf_dir), "RefundStatus", _status_table(spark), "status", "standard", "StandardStatus")
    return mapped.select("ReturnID", "RefundStatus", "StandardStatus")


def unmapped_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refund statuses that the stored table has no entry for."""
    return lookups.unmapped(_returns(spark, sf_dir), "RefundStatus", _status_table(spark), "status")


def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, undated ones too; the months of 1995 are written without amounts first, then replaced alone."""
    path = _new_folder(spark)
    name = f"orders_by_month_{path[-8:]}"
    monthly = _orders(spark, sf_dir, "ProductName", "OrderDate", "OrderAmount").withColumn("Order_Month", F.trunc("OrderDate", "month"))
    monthly = _stored(spark, monthly.select("OrderID", "ProductName", "OrderDate", "OrderAmount", "Order_Month"))  # written from twice
    in_1995 = F.coalesce(F.year("OrderDate") == 1995, F.lit(False))
    blank = F.when(~in_1995, F.col("OrderAmount"))
    by = ["Order_Month"]
    tables.write_table(
        tables.gathered(monthly.withColumn("OrderAmount", blank), by, ["ProductName"]), name, path=path, partition_by=by
    )
    tables.replace_partitions(tables.gathered(monthly.where(in_1995), by, ["ProductName"]), name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.parquet(path).select("OrderID", "ProductName", "OrderDate", "OrderAmount", "Order_Month")


def all_queries() -> dict[str, Query]:
    return {
        "scan_parquet": scan_parquet,
        "promote_header": promoted_returns,
        "table_roundtrip": table_roundtrip,
        "preview_limit": preview_limit,
        "rename_columns": rename_columns,
        "qualified_projection": qualified_projection,
        **RULES,
        "fill_nulls": fill_nulls,
        "drop_missing_keys": drop_missing_keys,
        "dedup_orders": dedup_orders,
        "silver_orders": _orders,
        "silver_inventory": _inventory,
        "silver_returns": _returns,
        "orders_left_returns": orders_left_returns,
        "enriched_left_inventory": enriched_left_inventory,
        "kpi_counts": _gold(gold.gold_product_kpis, "Total_Orders", "Total_Returns"),
        "kpi_distinct_customers": _gold(gold.gold_product_kpis, "Unique_Customers"),
        "kpi_return_rate": _gold(gold.gold_product_kpis, "Return_Rate_%"),
        "kpi_revenue": _gold(gold.gold_product_kpis, "Total_Revenue", "Avg_Order_Value"),
        "kpi_stock_cost_profit": _gold(gold.gold_product_kpis, "Total_Stock", "Avg_Cost", "Net_Profit"),
        "gold_product_kpis": _gold(gold.gold_product_kpis),
        "gold_kpi_by_product_month": _gold(gold.gold_kpi_by_product_month),
        "gold_kpi_no_fanout": _gold(gold.gold_kpi_no_fanout),
        "layered_pipeline": layered_pipeline,
        "bucketed_pipeline": bucketed_pipeline,
        "checked_pipeline": checked_pipeline,
        "typed_extracts": typed_extracts,
        "unknown_statuses": unknown_statuses,
        "check_returns": check_returns,
        "unknown_return_reasons": unknown_return_reasons,
        "map_refund_status": map_refund_status,
        "fix_customer_prefix": fix_customer_prefix,
        "dedup_returns": dedup_returns,
        "return_delays": return_delays,
        "product_month_trend": product_month_trend,
        "return_reasons": return_reasons,
        "customer_value": customer_value,
        "inventory_turnover": inventory_turnover,
        "partitioned_table": partitioned_table,
        "corrected_pipeline": corrected_pipeline,
        "rejected_returns": rejected_returns,
        "judged_gold": judged_gold,
        "customer_segments": customer_segments,
        "segment_profit": segment_profit,
        "product_calendar": product_calendar,
        "product_trend": product_trend,
        "mixed_extracts": mixed_extracts,
        "clustered_orders": clustered_orders,
        "merge_orders": merge_orders,
        "incremental_kpis": incremental_kpis,
        "similar_products": similar_products,
        "match_products": match_products,
        "map_status_table": map_status_table,
        "unmapped_statuses": unmapped_statuses,
    }
