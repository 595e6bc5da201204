"""Silver layer: raw extracts to renamed, typed and cleaned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as clean
from ..operators.rows import dedup, drop_missing, filled
from ..sources.schemas import RAW_INVENTORY, RAW_ORDERS, RAW_RETURNS, as_declared

# Raw column names and the names the cleaned tables use for them.
ORDER_NAMES = {
    "Order_ID": "OrderID",
    "cust_id": "CustomerID",
    "Product_Name": "ProductName",
    "Qty": "Quantity",
    "Order_Date": "OrderDate",
    "Order_Amount$": "OrderAmount",
    "Delivery_Status": "DeliveryStatus",
    "Payment_Mode": "PaymentMode",
    "Ship_Address": "ShipAddress",
    "Promo_Code": "PromoCode",
    "Feedback_Score": "FeedbackScore",
}
INVENTORY_NAMES = {
    "productName": "ProductName",
    "cost_price": "CostPrice",
    "last_stocked": "LastStocked",
    "stock": "Stock",
    "warehouse": "Warehouse",
    "available": "Available",
}
RETURN_NAMES = {
    "Return_ID": "ReturnID",
    "Order_ID": "OrderID",
    "Customer_ID": "CustomerID",
    "Return_Reason": "ReturnReason",
    "Return_Date": "ReturnDate",
    "Refund_Status": "RefundStatus",
    "Pickup_Address": "PickupAddress",
    "Return_Amount": "ReturnAmount",
}
ORDER_DEFAULTS = {"Quantity": 0, "OrderAmount": 0.0, "DeliveryStatus": "unknown", "PaymentMode": "unknown"}
ORDER_REQUIRED = ("CustomerID", "ProductName")

# The rule for each cleaned column.
ORDER_RULES = {
    "Quantity": clean.clean_quantity,
    "OrderDate": clean.clean_order_date,
    "OrderAmount": clean.clean_amount,
    "PaymentMode": clean.clean_payment_mode,
    "DeliveryStatus": clean.clean_delivery_status,
    "Email": clean.valid_email,
    "ShipAddress": clean.clean_ship_address,
    "FeedbackScore": clean.clean_feedback_score,
}
INVENTORY_RULES = {
    "Stock": clean.clean_stock,
    "LastStocked": clean.clean_last_stocked,
    "CostPrice": clean.clean_cost_price,
    "Warehouse": clean.clean_warehouse,
    "Available": clean.clean_available,
}
RETURN_RULES = {
    "ReturnDate": clean.clean_return_date,
    "RefundStatus": clean.clean_refund_status,
    "ReturnAmount": clean.clean_return_amount,
    "PickupAddress": clean.clean_pickup_address,
    "Product": clean.clean_product,
    "CustomerID": clean.clean_customer_id,
}


def apply_rules(df: DataFrame, rules: dict) -> DataFrame:
    """Replace each column by its cleaned form, all in one projection."""
    return df.withColumns({name: rule(F.col(name)) for name, rule in rules.items()})


def rename_orders(raw: DataFrame) -> DataFrame:
    return as_declared(raw, RAW_ORDERS).withColumnsRenamed(ORDER_NAMES)


def rename_inventory(raw: DataFrame) -> DataFrame:
    return as_declared(raw, RAW_INVENTORY).withColumnsRenamed(INVENTORY_NAMES)


def rename_returns(raw: DataFrame) -> DataFrame:
    return as_declared(raw, RAW_RETURNS).withColumnsRenamed(RETURN_NAMES)


def cleaned_orders(raw: DataFrame) -> DataFrame:
    """Renamed and typed orders, before nulls and duplicates are dealt with."""
    return raw.transform(rename_orders).transform(apply_rules, ORDER_RULES)


def silver_orders(raw: DataFrame, needed: Sequence[str] | None = None) -> DataFrame:
    """One row per OrderID, defaults filled, rows without customer or product dropped.

    With ``needed`` only the columns up to the last of those: of equal keys the row that is smallest by all columns
    is kept, and it is also the smallest by the first ones alone, so their values are the same without the others.
    """
    renamed = raw.transform(rename_orders).transform(drop_missing, ORDER_REQUIRED)
    if needed is not None:
        renamed = renamed.select(*renamed.columns[: max(map(renamed.columns.index, needed)) + 1])
    values = {}
    for name in renamed.columns:
        value = ORDER_RULES[name](F.col(name)) if name in ORDER_RULES else F.col(name)
        values[name] = filled(value, ORDER_DEFAULTS[name]) if name in ORDER_DEFAULTS else value
    return dedup(renamed, ["OrderID"], values)


def silver_inventory(raw: DataFrame) -> DataFrame:
    """Typed inventory; a product may have several rows."""
    return raw.transform(rename_inventory).transform(apply_rules, INVENTORY_RULES)


def silver_returns(raw: DataFrame) -> DataFrame:
    """Typed returns; an order may have several rows."""
    return raw.transform(rename_returns).transform(apply_rules, RETURN_RULES)
