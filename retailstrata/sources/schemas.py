"""Declared schemas of the raw extracts and the check made when one is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_ORDERS = _strings(
    "Order_ID",
    "cust_id",
    "Product_Name",
    "Qty",
    "Order_Date",
    "Order_Amount$",
    "Delivery_Status",
    "Payment_Mode",
    "Email",
    "Ship_Address",
    "Promo_Code",
    "Feedback_Score",
)
RAW_RETURNS = _strings(
    "Return_ID",
    "Order_ID",
    "Customer_ID",
    "Return_Reason",
    "Return_Date",
    "Refund_Status",
    "Pickup_Address",
    "Return_Amount",
    "Product",
)
RAW_INVENTORY = _strings("productName", "cost_price", "last_stocked", "stock", "warehouse", "available")


class SchemaMismatch(ValueError):
    """An extract lacks declared columns or has them in a type that has no text form."""


def check_schema(df: DataFrame, expected: T.StructType, what: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or name every missing or unusable column at once.

    Names compare without case, as column references do by default. Extra columns are allowed. Any atomic type
    will do, as ``as_declared`` can turn it into text; arrays, maps and structs will not.
    """
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name.lower() not in actual]
    wrong = [
        f"{f.name} is {actual[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}"
        for f in expected.fields
        if isinstance(actual.get(f.name.lower()), (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    ]
    if missing or wrong:
        parts = [f"missing columns: {', '.join(missing)}"] if missing else []
        raise SchemaMismatch(f"{what}: " + "; ".join(parts + wrong))
    return df


def as_declared(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns of other types cast to the declared ones; the rules read text."""
    declared = {f.name.lower(): f.dataType for f in expected.fields}
    casts = {
        f.name: F.col("`" + f.name.replace("`", "``") + "`").cast(declared[f.name.lower()])
        for f in df.schema.fields
        if f.name.lower() in declared and f.dataType != declared[f.name.lower()]
    }
    return df.withColumns(casts) if casts else df
