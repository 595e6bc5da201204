"""SQL oracles for the registered queries, in DuckDB's dialect.

They state the results the long way round: textual joins, ``row_number`` for the kept duplicate and
aggregates over the fully joined rows, so they share no shortcut with the Spark plans.
"""

from __future__ import annotations

from . import frames


def _duck(text: str) -> str:
    return text.format(**{t: t for t in frames.BASE_TABLES}).replace("`", '"').strip()


def _title(c: str, symbol_to: str) -> str:
    words = f"string_split(trim(regexp_replace({c}, '[^a-zA-Z0-9\\s]', '{symbol_to}', 'g')), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"


def _letters(c: str, keep: str = "") -> str:
    return f"lower(regexp_replace({c}, '[^a-zA-Z{keep}]', '', 'g'))"


def _number(c: str) -> str:
    return f"try_cast(regexp_extract({c}, '(\\d+\\.?\\d*)', 1) AS DOUBLE)"


def _dates(c: str, *formats: str) -> str:
    return f"cast(coalesce({', '.join(f'try_strptime({c}, {f!r})' for f in formats)}) AS DATE)"


def _stock(c: str) -> str:
    words = {"twenty five": 25, "twenty": 20, "eighteen": 18, "fifteen": 15, "twelve": 12}
    cases = " ".join(f"WHEN {c} LIKE '%{w}%' THEN {n}" for w, n in words.items())
    return f"CASE WHEN regexp_matches({c}, '^[0-9]+$') THEN try_cast({c} AS INTEGER) {cases} END"


def _round2(x: str) -> str:
    """Half-up rounding of the decimal form of a double, as Spark rounds."""
    return f"cast(round(cast(cast({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


# Cleaned form of each raw column.
QUANTITY = """CASE lower("Qty") WHEN 'one' THEN 1 WHEN 'two' THEN 2 WHEN 'three' THEN 3
  ELSE try_cast("Qty" AS INTEGER) END"""
ORDER_DATE = _dates('"Order_Date"', "%Y/%m/%d", "%d-%m-%Y", "%m-%d-%Y", "%Y.%m.%d", "%d/%m/%Y", "%d.%m.%Y", "%B %d %Y")
AMOUNT = """try_cast(regexp_replace("Order_Amount$", '[$₹Rs. USD, INR]', '', 'g') AS DOUBLE)"""
AMOUNT_DOCUMENTED = """try_cast(regexp_replace("Order_Amount$", 'Rs\\.?|USD|INR|[$₹,\\s]', '', 'g') AS DOUBLE)"""
PAYMENT = _letters('"Payment_Mode"')
DELIVERY = _letters('"Delivery_Status"', keep=" ")
DELIVERY_DOCUMENTED = """lower(trim(regexp_replace("Delivery_Status", '[^a-zA-Z]+', ' ', 'g')))"""
EMAIL = """CASE WHEN regexp_matches("Email", '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') THEN "Email" END"""
ADDRESS = """regexp_replace("Ship_Address", '[#@!$]', '', 'g')"""
FEEDBACK = 'try_cast("Feedback_Score" AS DOUBLE)'
STOCK = _stock('"stock"')
STOCK_DOCUMENTED = _stock('lower("stock")')
STOCKED = _dates("regexp_replace(\"last_stocked\", '[./]', '-', 'g')", "%Y-%m-%d")
COST = _number('"cost_price"')
WAREHOUSE = _title('"warehouse"', " ")
AVAILABLE = """CASE WHEN lower("available") IN ('yes', 'y', 'true') THEN true
  WHEN lower("available") IN ('no', 'n', 'false') THEN false END"""
RETURN_DATE = _dates("regexp_replace(\"Return_Date\", '[./]', '-', 'g')", "%d-%m-%Y")
REFUND = _letters('"Refund_Status"')
RETURN_AMOUNT = _number('"Return_Amount"')
PICKUP = _title('"Pickup_Address"', " ")
PRODUCT = _title('"Product"', "")
PRODUCT_DOCUMENTED = _title('"Product"', " ")
CUSTOMER = 'trim(upper("Customer_ID"))'

CTES = {
    "raw_orders": _duck(frames.RAW_ORDERS),
    "raw_returns": _duck(frames.RAW_RETURNS),
    "raw_inventory": _duck(frames.RAW_INVENTORY),
    "renamed_orders": """SELECT "Order_ID" AS "OrderID", "cust_id" AS "CustomerID", "Product_Name" AS "ProductName",
  "Qty" AS "Quantity", "Order_Date" AS "OrderDate", "Order_Amount$" AS "OrderAmount",
  "Delivery_Status" AS "DeliveryStatus", "Payment_Mode" AS "PaymentMode", "Email",
  "Ship_Address" AS "ShipAddress", "Promo_Code" AS "PromoCode", "Feedback_Score" AS "FeedbackScore"
FROM raw_orders""",
    "filled_orders": f"""SELECT "Order_ID" AS "OrderID", "cust_id" AS "CustomerID", "Product_Name" AS "ProductName",
  coalesce({QUANTITY}, 0) AS "Quantity", {ORDER_DATE} AS "OrderDate", coalesce({AMOUNT}, 0.0) AS "OrderAmount",
  coalesce({DELIVERY}, 'unknown') AS "DeliveryStatus", coalesce({PAYMENT}, 'unknown') AS "PaymentMode",
  {EMAIL} AS "Email", {ADDRESS} AS "ShipAddress", "Promo_Code" AS "PromoCode", {FEEDBACK} AS "FeedbackScore"
FROM raw_orders""",
    "silver_orders": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "OrderID" ORDER BY
    "CustomerID" NULLS FIRST, "ProductName" NULLS FIRST, "Quantity" NULLS FIRST, "OrderDate" NULLS FIRST,
    "OrderAmount" NULLS FIRST, "DeliveryStatus" NULLS FIRST, "PaymentMode" NULLS FIRST, "Email" NULLS FIRST,
    "ShipAddress" NULLS FIRST, "PromoCode" NULLS FIRST, "FeedbackScore" NULLS FIRST) AS rn
  FROM filled_orders WHERE "CustomerID" IS NOT NULL AND "ProductName" IS NOT NULL) WHERE rn = 1""",
    "silver_inventory": f"""SELECT "productName" AS "ProductName", {COST} AS "CostPrice", {STOCKED} AS "LastStocked",
  {STOCK} AS "Stock", {WAREHOUSE} AS "Warehouse", {AVAILABLE} AS "Available" FROM raw_inventory""",
    "silver_returns": f"""SELECT "Return_ID" AS "ReturnID", "Order_ID" AS "OrderID", {CUSTOMER} AS "CustomerID",
  "Return_Reason" AS "ReturnReason", {RETURN_DATE} AS "ReturnDate", {REFUND} AS "RefundStatus",
  {PICKUP} AS "PickupAddress", {RETURN_AMOUNT} AS "ReturnAmount", {PRODUCT} AS "Product" FROM raw_returns""",
    "enriched": """SELECT o."ProductName", o."OrderID", o."CustomerID", o."OrderAmount", o."OrderDate", r."ReturnID",
  i."Stock", i."CostPrice"
FROM silver_orders o LEFT JOIN silver_returns r ON o."OrderID" = r."OrderID"
LEFT JOIN silver_inventory i ON o."ProductName" = i."ProductName\"""",
}
_NEEDS = {
    "renamed_orders": ("raw_orders",),
    "filled_orders": ("raw_orders",),
    "silver_orders": ("filled_orders",),
    "silver_inventory": ("raw_inventory",),
    "silver_returns": ("raw_returns",),
    "enriched": ("silver_orders", "silver_returns", "silver_inventory"),
}


def with_ctes(select: str, *names: str, **extra: str) -> str:
    """``select`` preceded by the named common tables and all they are built from."""
    order: list[str] = []

    def need(name: str) -> None:
        for dependency in _NEEDS.get(name, ()):
            need(dependency)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    parts = [f"{n} AS (\n{CTES[n]}\n)" for n in order] + [f"{n} AS (\n{text}\n)" for n, text in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select


KPIS = {
    "Total_Orders": 'count("OrderID")',
    "Unique_Customers": 'count(DISTINCT "CustomerID")',
    "Total_Returns": 'count("ReturnID")',
    "Return_Rate_%": _round2('count("ReturnID") / nullif(count("OrderID"), 0) * 100'),
    "Total_Revenue": _round2('sum("OrderAmount")'),
    "Avg_Order_Value": _round2('avg("OrderAmount")'),
    "Total_Stock": 'cast(sum("Stock") AS BIGINT)',
    "Avg_Cost": _round2('avg("CostPrice")'),
    "Net_Profit": _round2('sum("OrderAmount") - cast(sum("Stock") AS BIGINT) * avg("CostPrice")'),
}


def kpis(*names: str) -> str:
    chosen = ", ".join(f'{KPIS[n]} AS "{n}"' for n in names or KPIS)
    return with_ctes(f'SELECT "ProductName", {chosen} FROM enriched GROUP BY "ProductName"', "enriched")


def rule(raw: str, key: str, column: str, cleaned: str, name: str) -> str:
    return with_ctes(f'SELECT "{key}", "{column}" AS raw_value, {cleaned} AS "{name}" FROM {raw}', raw)


RULES = {
    # query: (raw table, key, raw column, cleaned expression, output name)
    "clean_quantity": ("raw_orders", "Order_ID", "Qty", QUANTITY, "Quantity"),
    "clean_order_date": ("raw_orders", "Order_ID", "Order_Date", ORDER_DATE, "OrderDate"),
    "clean_amount": ("raw_orders", "Order_ID", "Order_Amount$", AMOUNT, "OrderAmount"),
    "clean_payment_mode": ("raw_orders", "Order_ID", "Payment_Mode", PAYMENT, "PaymentMode"),
    "clean_delivery_status": ("raw_orders", "Order_ID", "Delivery_Status", DELIVERY, "DeliveryStatus"),
    "validate_email": ("raw_orders", "Order_ID", "Email", EMAIL, "Email"),
    "clean_ship_address": ("raw_orders", "Order_ID", "Ship_Address", ADDRESS, "ShipAddress"),
    "clean_feedback": ("raw_orders", "Order_ID", "Feedback_Score", FEEDBACK, "FeedbackScore"),
    "clean_stock": ("raw_inventory", "productName", "stock", STOCK, "Stock"),
    "clean_last_stocked": ("raw_inventory", "productName", "last_stocked", STOCKED, "LastStocked"),
    "clean_cost_price": ("raw_inventory", "productName", "cost_price", COST, "CostPrice"),
    "clean_warehouse": ("raw_inventory", "productName", "warehouse", WAREHOUSE, "Warehouse"),
    "clean_available": ("raw_inventory", "productName", "available", AVAILABLE, "Available"),
    "clean_return_date": ("raw_returns", "Return_ID", "Return_Date", RETURN_DATE, "ReturnDate"),
    "clean_refund_status": ("raw_returns", "Return_ID", "Refund_Status", REFUND, "RefundStatus"),
    "clean_return_amount": ("raw_returns", "Return_ID", "Return_Amount", RETURN_AMOUNT, "ReturnAmount"),
    "clean_pickup_address": ("raw_returns", "Return_ID", "Pickup_Address", PICKUP, "PickupAddress"),
    "clean_product": ("raw_returns", "Return_ID", "Product", PRODUCT, "Product"),
    "clean_customer_id": ("raw_returns", "Return_ID", "Customer_ID", CUSTOMER, "CustomerID"),
    "clean_amount_documented": ("raw_orders", "Order_ID", "Order_Amount$", AMOUNT_DOCUMENTED, "OrderAmount"),
    "clean_delivery_status_documented": (
        "raw_orders", "Order_ID", "Delivery_Status", DELIVERY_DOCUMENTED, "DeliveryStatus",
    ),
    "clean_product_documented": ("raw_returns", "Return_ID", "Product", PRODUCT_DOCUMENTED, "Product"),
    "clean_stock_documented": ("raw_inventory", "productName", "stock", STOCK_DOCUMENTED, "Stock"),
}

NO_FANOUT = """SELECT o."ProductName", o.n AS "Total_Orders", o.customers AS "Unique_Customers",
  coalesce(r.n, 0) AS "Total_Returns", {rate} AS "Return_Rate_%", {revenue} AS "Total_Revenue",
  {value} AS "Avg_Order_Value", i.stock AS "Total_Stock", {cost} AS "Avg_Cost", {profit} AS "Net_Profit"
FROM (SELECT "ProductName", count("OrderID") AS n, count(DISTINCT "CustomerID") AS customers,
        sum("OrderAmount") AS revenue, avg("OrderAmount") AS value FROM silver_orders GROUP BY "ProductName") o
LEFT JOIN (SELECT s."ProductName", count(t."ReturnID") AS n FROM silver_orders s JOIN silver_returns t
        ON s."OrderID" = t."OrderID" GROUP BY s."ProductName") r ON o."ProductName" = r."ProductName"
LEFT JOIN (SELECT "ProductName", cast(sum("Stock") AS BIGINT) AS stock, avg("CostPrice") AS cost
        FROM silver_inventory GROUP BY "ProductName") i ON o."ProductName" = i."ProductName\"""".format(
    rate=_round2("coalesce(r.n, 0) / nullif(o.n, 0) * 100"),
    revenue=_round2("o.revenue"),
    value=_round2("o.value"),
    cost=_round2("i.cost"),
    profit=_round2("o.revenue - i.stock * i.cost"),
)

BY_MONTH = (
    'SELECT "ProductName", cast(date_trunc(\'month\', "OrderDate") AS DATE) AS "Order_Month", '
    + ", ".join(f'{sql} AS "{name}"' for name, sql in KPIS.items())
    + ' FROM enriched GROUP BY "ProductName", cast(date_trunc(\'month\', "OrderDate") AS DATE)'
)


def _money(c: str) -> str:
    return f"cast(sum(cast({c} AS DECIMAL(38, 10))) AS DOUBLE)"


DATED_RETURNS = """SELECT r.*, o."OrderDate" FROM silver_returns r LEFT JOIN silver_orders o ON r."OrderID" = o."OrderID\""""

CHECKS = """SELECT count(*) AS "Rows", count(*) FILTER ("ReturnAmount" <= 0) AS "AmountPositive",
  count(*) FILTER ("ReturnDate" > DATE '1999-12-31') AS "DateNotInFuture",
  count(*) FILTER ("ReturnDate" <= "OrderDate") AS "DateAfterOrder" FROM dated"""

TREND = f"""SELECT "ProductName", "Order_Month", cast(year("Order_Month") AS INTEGER) AS "Order_Year",
  cast(month("Order_Month") AS INTEGER) AS "Month_Of_Year",
  "Revenue", "Revenue" - lag("Revenue") OVER w AS "Revenue_Change",
  CASE WHEN "Order_Month" IS NOT NULL THEN {_round2('avg("Revenue") OVER (PARTITION BY "ProductName", "Order_Month" IS NOT NULL ORDER BY "Order_Month" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')}
    END AS "Rolling_Revenue"
FROM (SELECT "ProductName", cast(date_trunc('month', "OrderDate") AS DATE) AS "Order_Month", {_money('"OrderAmount"')} AS "Revenue"
  FROM silver_orders GROUP BY ALL)
WINDOW w AS (PARTITION BY "ProductName", "Order_Month" IS NOT NULL ORDER BY "Order_Month")"""

REASONS = f"""SELECT *, {_round2('"Returned_Amount" / nullif("Priced_Returns", 0)')} AS "Avg_Returned_Amount"
FROM (SELECT "ReturnReason", count(*) AS "Returns", count("ReturnAmount") AS "Priced_Returns",
  {_money('"ReturnAmount"')} AS "Returned_Amount" FROM silver_returns GROUP BY "ReturnReason")"""

CUSTOMERS = f"""SELECT c."CustomerID", c."Orders", c."Revenue", coalesce(r.amount, 0.0) AS "Returned_Amount",
  {_round2('c."Revenue" - coalesce(r.amount, 0.0)')} AS "Lifetime_Value"
FROM (SELECT "CustomerID", count("OrderID") AS "Orders", {_money('"OrderAmount"')} AS "Revenue"
  FROM silver_orders GROUP BY "CustomerID") c
LEFT JOIN (SELECT o."CustomerID", {_money('t."ReturnAmount"')} AS amount FROM silver_orders o
  JOIN silver_returns t ON o."OrderID" = t."OrderID" GROUP BY o."CustomerID") r ON c."CustomerID" = r."CustomerID\""""

TURNOVER = f"""SELECT s."ProductName", s."Units_Sold", i."Units_In_Stock",
  {_round2('s."Units_Sold" / nullif(i."Units_In_Stock", 0)')} AS "Turnover"
FROM (SELECT "ProductName", cast(sum("Quantity") AS BIGINT) AS "Units_Sold" FROM silver_orders GROUP BY "ProductName") s
LEFT JOIN (SELECT "ProductName", cast(sum("Stock") AS BIGINT) AS "Units_In_Stock" FROM silver_inventory
  GROUP BY "ProductName") i ON s."ProductName" = i."ProductName\""""

PREFIXES = """SELECT "ReturnID", raw_value, CASE WHEN raw_value LIKE 'CUST%' THEN raw_value
  WHEN raw_value LIKE 'CST%' THEN 'CUST' || substr(raw_value, 4) WHEN raw_value LIKE 'CT%' THEN 'CUST' || substr(raw_value, 3)
  ELSE raw_value END AS "CustomerID"
FROM (SELECT "ReturnID", CASE cast(substr("CustomerID", 5) AS INTEGER) % 3 WHEN 0 THEN 'CUST' WHEN 1 THEN 'CST' ELSE 'CT' END
  || substr("CustomerID", 5) AS raw_value FROM silver_returns)"""

DEDUP_RETURNS = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "ReturnID" ORDER BY
  "OrderID" NULLS FIRST, "CustomerID" NULLS FIRST, "ReturnReason" NULLS FIRST, "ReturnDate" NULLS FIRST,
  "RefundStatus" NULLS FIRST, "PickupAddress" NULLS FIRST, "ReturnAmount" NULLS FIRST, "Product" NULLS FIRST) AS rn
FROM silver_returns) WHERE rn = 1"""


# --- segments, months, loads, misspelled names -----------------------------------------------------------

SEGMENTED = f"""SELECT *, CASE WHEN "Recency_Class" >= 4 AND "Frequency_Class" >= 4 AND "Value_Class" >= 4 THEN 'champion'
  WHEN "Frequency_Class" >= 4 THEN 'loyal' WHEN "Value_Class" >= 4 THEN 'big spender' WHEN "Recency_Class" >= 4 THEN 'recent'
  WHEN "Recency_Class" <= 2 AND "Frequency_Class" <= 2 THEN 'lapsed' ELSE 'regular' END AS "Segment"
FROM (SELECT *, {", ".join(
    f'cast(ntile(5) OVER (ORDER BY "{value}" NULLS FIRST, "CustomerID") AS INTEGER) AS "{name}"'
    for value, name in (("Last_Order", "Recency_Class"), ("Orders", "Frequency_Class"), ("Revenue", "Value_Class"))
)} FROM (SELECT "CustomerID", max("OrderDate") AS "Last_Order", count("OrderID") AS "Orders", {_money('"OrderAmount"')} AS "Revenue"
  FROM silver_orders GROUP BY "CustomerID"))"""

_EXACT = "cast({} AS DECIMAL(38, 10))"
PROFIT = f"""SELECT CASE WHEN grouping("ProductName") = 0 AND grouping("Segment") = 0 THEN 'product and segment'
  WHEN grouping("ProductName") = 0 THEN 'product' WHEN grouping("Segment") = 0 THEN 'segment' ELSE 'all' END AS "Level",
  "ProductName", "Segment", count(DISTINCT ("CustomerID", "ProductName")) AS "Customer_Products", count("OrderID") AS "Orders",
  {_round2('cast(sum(revenue) AS DOUBLE)')} AS "Revenue", {_round2('coalesce(cast(sum(returned) AS DOUBLE), 0.0)')} AS "Returned_Amount",
  coalesce(cast(sum("Quantity" * unit) AS DOUBLE), 0.0) AS "Cost",
  {_round2('cast(sum(revenue) AS DOUBLE) - coalesce(cast(sum(returned) AS DOUBLE), 0.0) - coalesce(cast(sum("Quantity" * unit) AS DOUBLE), 0.0)')} AS "Profit"
FROM (SELECT o.*, {_EXACT.format('o."OrderAmount"')} AS revenue, s."Segment", r.returned, cast(i.unit AS DECIMAL(18, 2)) AS unit
  FROM silver_orders o JOIN segmented s ON o."CustomerID" = s."CustomerID"
  LEFT JOIN (SELECT "OrderID", sum({_EXACT.format('"ReturnAmount"')}) AS returned FROM silver_returns GROUP BY "OrderID") r ON o."OrderID" = r."OrderID"
  LEFT JOIN (SELECT "ProductName" AS p, {_round2('avg("CostPrice")')} AS unit FROM silver_inventory GROUP BY "ProductName") i ON o."ProductName" = i.p)
GROUP BY GROUPING SETS (("ProductName", "Segment"), ("ProductName"), ("Segment"), ())"""

MONTHS = f"""SELECT s."ProductName", s."Order_Month", coalesce(m.n, 0) AS "Orders", coalesce(m.revenue, 0.0) AS "Revenue"
FROM (SELECT "ProductName", cast(unnest(generate_series(min(date_trunc('month', "OrderDate")), max(date_trunc('month', "OrderDate")), INTERVAL 1 MONTH)) AS DATE) AS "Order_Month"
  FROM silver_orders WHERE "OrderDate" IS NOT NULL GROUP BY "ProductName") s
LEFT JOIN (SELECT "ProductName", cast(date_trunc('month', "OrderDate") AS DATE) AS "Order_Month", count(*) AS n, {_money('"OrderAmount"')} AS revenue
  FROM silver_orders GROUP BY ALL) m ON s."ProductName" = m."ProductName" AND s."Order_Month" = m."Order_Month\""""

CALENDAR = f"""SELECT m.*, {_round2('m."Revenue" - b."Revenue"')} AS "Revenue_Change",
  {_round2('(SELECT avg(w."Revenue") FROM months w WHERE w."ProductName" = m."ProductName" AND w."Order_Month" BETWEEN m."Order_Month" - INTERVAL 2 MONTH AND m."Order_Month")')} AS "Rolling_Revenue",
  y."Revenue" AS "Revenue_Year_Before"
FROM months m LEFT JOIN months b ON b."ProductName" = m."ProductName" AND b."Order_Month" = m."Order_Month" - INTERVAL 1 MONTH
LEFT JOIN months y ON y."ProductName" = m."ProductName" AND y."Order_Month" = m."Order_Month" - INTERVAL 1 YEAR"""

PRODUCT_TREND = f"""SELECT m."ProductName", count(*) AS "Months",
  CASE WHEN count(*) > 1 THEN {_round2('regr_slope(m."Revenue", year(m."Order_Month") * 12 + month(m."Order_Month"))')} END AS "Monthly_Growth",
  CASE WHEN count(*) > 1 THEN round(regr_r2(m."Revenue", year(m."Order_Month") * 12 + month(m."Order_Month")), 6) END AS "Fit",
  {_round2('max(m."Revenue" - y."Revenue")')} AS "Best_Year_Change"
FROM months m LEFT JOIN months y ON y."ProductName" = m."ProductName" AND y."Order_Month" = m."Order_Month" - INTERVAL 1 YEAR
GROUP BY m."ProductName\""""

MERGED = """SELECT *, cast(date_trunc('month', "OrderDate") AS DATE) AS "Order_Month"
FROM (SELECT * REPLACE (CASE WHEN "Quantity" % 3 = 1 THEN "OrderAmount" + 1 ELSE "OrderAmount" END AS "OrderAmount",
    CASE WHEN "Quantity" % 3 = 1 THEN cast("OrderDate" + 40 AS DATE) ELSE "OrderDate" END AS "OrderDate"),
  cast(CASE "Quantity" % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 2 END AS INTEGER) AS "Version" FROM silver_orders)"""

MOVED = """SELECT * REPLACE (CASE WHEN "Quantity" % 6 = 1 THEN "OrderAmount" + 1 ELSE "OrderAmount" END AS "OrderAmount",
  CASE WHEN "Quantity" % 6 = 1 THEN "CustomerID" || 'x' ELSE "CustomerID" END AS "CustomerID",
  CASE WHEN "Quantity" % 6 = 1 THEN 'hot product' ELSE "ProductName" END AS "ProductName") FROM silver_orders"""


def _kpis_over(orders: str, returns: str) -> str:
    chosen = ", ".join(f'{sql} AS "{name}"' for name, sql in KPIS.items())
    rows = CTES["enriched"].replace("silver_orders", orders).replace("silver_returns", returns)
    return f'SELECT "ProductName", {chosen} FROM ({rows}) GROUP BY "ProductName"'


SIMILAR = """SELECT x.t AS a, y.t AS b, cast(levenshtein(x.t, y.t) AS INTEGER) AS distance, x.n AS rows_a, y.n AS rows_b
FROM names x JOIN names y ON x.t < y.t AND levenshtein(x.t, y.t) <= 2"""

MATCHED = """SELECT u.t AS text, m.match, cast(m.distance AS INTEGER) AS distance, coalesce(m.ties, 0) AS ties FROM unknown u
LEFT JOIN (SELECT u.t, min(n.t) AS match, levenshtein(u.t, n.t) AS distance, count(*) AS ties FROM unknown u JOIN names n
    ON levenshtein(u.t, n.t) <= 1 GROUP BY u.t, levenshtein(u.t, n.t)
  QUALIFY row_number() OVER (PARTITION BY u.t ORDER BY levenshtein(u.t, n.t)) = 1) m ON u.t = m.t"""
NAMES = 'SELECT "ProductName" AS t, count(*) AS n FROM silver_inventory WHERE "ProductName" IS NOT NULL GROUP BY "ProductName"'
UNKNOWN = """SELECT DISTINCT t FROM (SELECT CASE "Quantity" % 5 WHEN 0 THEN substr("ProductName", 1, 2) || substr("ProductName", 4)
  WHEN 1 THEN substr("ProductName", 1, 3) || 'x' || substr("ProductName", 4) ELSE "ProductName" END AS t FROM silver_orders)
WHERE t NOT IN (SELECT t FROM names)"""

# Broken checks of a return by their names, and whether there are any.
_BROKEN = """concat_ws(',', CASE WHEN "ReturnAmount" <= 0 THEN 'AmountPositive' END,
  CASE WHEN "ReturnDate" > DATE '1999-12-31' THEN 'DateNotInFuture' END, CASE WHEN "ReturnDate" <= "OrderDate" THEN 'DateAfterOrder' END)"""
JUDGED = f"""SELECT *, {_BROKEN} AS "Reject_Reasons" FROM dated"""

MISSPELLED = """SELECT * REPLACE (CASE cast(substr(trim("Customer_ID"), 5) AS INTEGER) % 3 WHEN 0 THEN 'CUST' WHEN 1 THEN 'CST' ELSE 'CT' END
  || substr(trim("Customer_ID"), 5) AS "Customer_ID") FROM raw_returns"""


def all_oracles() -> dict[str, str]:
    sql = {name: rule(*args) for name, args in RULES.items()}
    sql |= {
        "scan_parquet": with_ctes("SELECT * FROM raw_orders", "raw_orders"),
        "promote_header": with_ctes("SELECT * FROM raw_returns", "raw_returns"),
        "table_roundtrip": with_ctes("SELECT * FROM silver_returns", "silver_returns"),
        "layered_pipeline": kpis(),
        "bucketed_pipeline": kpis(),
        "checked_pipeline": with_ctes(
            CHECKS.replace("dated", "deduped"), "silver_orders", "silver_returns",
            one=DEDUP_RETURNS, deduped=DATED_RETURNS.replace("silver_returns", "one"),
        ),
        "typed_extracts": with_ctes(
            f"""SELECT "ProductName", try_cast(nullif(regexp_extract("cost_price", '[0-9.]+'), '') AS DOUBLE) AS "CostPrice", {STOCKED} AS "LastStocked",
  try_cast("stock" AS INTEGER) AS "Stock", {WAREHOUSE} AS "Warehouse", {AVAILABLE} AS "Available"
FROM (SELECT * EXCLUDE ("productName"), "productName" AS "ProductName" FROM raw_inventory)""",
            "raw_inventory",
        ),
        "unknown_statuses": with_ctes(
            """SELECT "RefundStatus", count(*) AS "Rows" FROM silver_returns WHERE "RefundStatus" IS NULL OR "RefundStatus" NOT IN
  ('pending', 'inprogress', 'completed', 'rejected', 'cancelled', 'initiated') GROUP BY "RefundStatus\"""",
            "silver_returns",
        ),
        "preview_limit": with_ctes(
            'SELECT * FROM silver_inventory ORDER BY "ProductName" NULLS FIRST, "Warehouse" NULLS FIRST LIMIT 5',
            "silver_inventory",
        ),
        "rename_columns": with_ctes("SELECT * FROM renamed_orders", "renamed_orders"),
        "qualified_projection": with_ctes('SELECT * EXCLUDE ("OrderDate") FROM enriched', "enriched"),
        "fill_nulls": with_ctes(
            'SELECT "OrderID", "Quantity", "OrderAmount", "DeliveryStatus", "PaymentMode" FROM filled_orders',
            "filled_orders",
        ),
        "drop_missing_keys": with_ctes(
            'SELECT "OrderID", "CustomerID", "ProductName" FROM renamed_orders '
            'WHERE "CustomerID" IS NOT NULL AND "ProductName" IS NOT NULL',
            "renamed_orders",
        ),
        "dedup_orders": with_ctes(
            """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "OrderID" ORDER BY
  "CustomerID" NULLS FIRST, "ProductName" NULLS FIRST, "Quantity" NULLS FIRST, "OrderDate" NULLS FIRST,
  "OrderAmount" NULLS FIRST, "DeliveryStatus" NULLS FIRST, "PaymentMode" NULLS FIRST, "Email" NULLS FIRST,
  "ShipAddress" NULLS FIRST, "PromoCode" NULLS FIRST, "FeedbackScore" NULLS FIRST) AS rn
FROM renamed_orders) WHERE rn = 1""",
            "renamed_orders",
        ),
        "silver_orders": with_ctes("SELECT * FROM silver_orders", "silver_orders"),
        "silver_inventory": with_ctes("SELECT * FROM silver_inventory", "silver_inventory"),
        "silver_returns": with_ctes("SELECT * FROM silver_returns", "silver_returns"),
        "orders_left_returns": with_ctes(
            """SELECT o.*, r."ReturnID", r."ReturnReason", r."ReturnDate", r."RefundStatus", r."PickupAddress",
  r."ReturnAmount", r."Product", r."CustomerID" AS "ReturnCustomerID"
FROM silver_orders o LEFT JOIN silver_returns r ON o."OrderID" = r."OrderID\"""",
            "silver_orders",
            "silver_returns",
        ),
        "enriched_left_inventory": with_ctes(
            """SELECT o."OrderID", o."ProductName", r."ReturnID", i."CostPrice", i."LastStocked", i."Stock", i."Warehouse",
  i."Available" FROM silver_orders o LEFT JOIN silver_returns r ON o."OrderID" = r."OrderID"
LEFT JOIN silver_inventory i ON o."ProductName" = i."ProductName\"""",
            "silver_orders",
            "silver_returns",
            "silver_inventory",
        ),
        "kpi_counts": kpis("Total_Orders", "Total_Returns"),
        "kpi_distinct_customers": kpis("Unique_Customers"),
        "kpi_return_rate": kpis("Return_Rate_%"),
        "kpi_revenue": kpis("Total_Revenue", "Avg_Order_Value"),
        "kpi_stock_cost_profit": kpis("Total_Stock", "Avg_Cost", "Net_Profit"),
        "gold_product_kpis": kpis(),
        "gold_kpi_by_product_month": with_ctes(BY_MONTH, "enriched"),
        "check_returns": with_ctes(
            CHECKS,
            "silver_orders", "silver_returns", dated=DATED_RETURNS,
        ),
        "unknown_return_reasons": with_ctes(
            """SELECT "ReturnReason", count(*) AS "Rows" FROM silver_returns
WHERE "ReturnReason" IS NULL OR "ReturnReason" NOT IN ('Damaged', 'Late') GROUP BY "ReturnReason\"""",
            "silver_returns",
        ),
        "map_refund_status": with_ctes(
            """SELECT "ReturnID", "RefundStatus", CASE "RefundStatus" WHEN 'inprogress' THEN 'in progress'
  WHEN 'failed' THEN 'rejected' ELSE "RefundStatus" END AS "StandardStatus" FROM silver_returns""",
            "silver_returns",
        ),
        "fix_customer_prefix": with_ctes(PREFIXES, "silver_returns"),
        "dedup_returns": with_ctes(DEDUP_RETURNS, "silver_returns"),
        "return_delays": with_ctes(
            """SELECT "ReturnID", "OrderID", cast(date_diff('day', "OrderDate", "ReturnDate") AS INTEGER) AS "Days_To_Return",
  coalesce("ReturnAmount" > 1000, false) AS "High_Value" FROM dated""",
            "silver_orders", "silver_returns", dated=DATED_RETURNS,
        ),
        "product_month_trend": with_ctes(TREND, "silver_orders"),
        "return_reasons": with_ctes(REASONS, "silver_returns"),
        "customer_value": with_ctes(CUSTOMERS, "silver_orders", "silver_returns"),
        "inventory_turnover": with_ctes(TURNOVER, "silver_orders", "silver_inventory"),
        "partitioned_table": with_ctes(
            """SELECT "OrderID", "ProductName", "OrderDate", "OrderAmount",
  cast(date_trunc('month', "OrderDate") AS DATE) AS "Order_Month" FROM silver_orders""",
            "silver_orders",
        ),
        "customer_segments": with_ctes(SEGMENTED, "silver_orders"),
        "segment_profit": with_ctes(PROFIT, "silver_orders", "silver_returns", "silver_inventory", segmented=SEGMENTED),
        "product_calendar": with_ctes(CALENDAR, "silver_orders", months=MONTHS),
        "product_trend": with_ctes(PRODUCT_TREND, "silver_orders", months=MONTHS),
        "merge_orders": with_ctes(MERGED, "silver_orders"),
        "clustered_orders": with_ctes(
            """SELECT "OrderID", "ProductName", "OrderDate", "OrderAmount", 'product' AS "Asked" FROM silver_orders WHERE "ProductName" = 'hot product'
UNION ALL SELECT "OrderID", "ProductName", "OrderDate", "OrderAmount", 'month' FROM silver_orders
WHERE "OrderDate" BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'""",
            "silver_orders",
        ),
        "mixed_extracts": with_ctes(
            f"""SELECT "ProductName", CASE kind WHEN 1 THEN try_cast(nullif(regexp_extract("cost_price", '[0-9.]+'), '') AS DOUBLE) ELSE {COST} END AS "CostPrice",
  {STOCKED} AS "LastStocked", CASE kind WHEN 0 THEN {STOCK} ELSE try_cast("stock" AS INTEGER) END AS "Stock", {WAREHOUSE} AS "Warehouse", {AVAILABLE} AS "Available"
FROM (SELECT * EXCLUDE ("productName"), "productName" AS "ProductName", length("productName") % 3 AS kind FROM raw_inventory)""",
            "raw_inventory",
        ),
        "incremental_kpis": with_ctes(_kpis_over("moved", "silver_returns"), "silver_orders", "silver_returns", "silver_inventory", moved=MOVED),
        "similar_products": with_ctes(SIMILAR, "silver_inventory", names=NAMES),
        "match_products": with_ctes(MATCHED, "silver_orders", "silver_inventory", names=NAMES, unknown=UNKNOWN),
        "map_status_table": with_ctes(
            """SELECT "ReturnID", "RefundStatus", CASE "RefundStatus" WHEN 'inprogress' THEN 'in progress'
  WHEN 'failed' THEN 'rejected' ELSE "RefundStatus" END AS "StandardStatus" FROM silver_returns""",
            "silver_returns",
        ),
        "unmapped_statuses": with_ctes(
            """SELECT "RefundStatus", count(*) AS "Rows" FROM silver_returns
WHERE "RefundStatus" IS NULL OR "RefundStatus" NOT IN ('inprogress', 'failed') GROUP BY "RefundStatus\"""",
            "silver_returns",
        ),
        "rejected_returns": with_ctes(
            """SELECT * EXCLUDE ("OrderDate") FROM judged WHERE "Reject_Reasons" <> ''""",
            "silver_orders", "silver_returns", dated=DATED_RETURNS, judged=JUDGED,
        ),
        "judged_gold": with_ctes(
            _kpis_over("silver_orders", "accepted"), "silver_orders", "silver_returns", "silver_inventory",
            dated=DATED_RETURNS, judged=JUDGED, accepted="""SELECT * FROM judged WHERE "Reject_Reasons" = ''""",
        ),
        "corrected_pipeline": with_ctes(
            DEDUP_RETURNS.replace("silver_returns", "corrected"), "raw_returns", misspelled=MISSPELLED,
            cleaned=CTES["silver_returns"].replace("raw_returns", "misspelled"),
            corrected="""SELECT * REPLACE (CASE WHEN "CustomerID" LIKE 'CUST%' THEN "CustomerID"
  WHEN "CustomerID" LIKE 'CST%' THEN 'CUST' || substr("CustomerID", 4) WHEN "CustomerID" LIKE 'CT%' THEN 'CUST' || substr("CustomerID", 3)
  ELSE "CustomerID" END AS "CustomerID") FROM cleaned""",
        ),
        "gold_kpi_no_fanout": with_ctes(NO_FANOUT, "silver_orders", "silver_returns", "silver_inventory"),
    }
    return sql
