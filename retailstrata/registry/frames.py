"""Dirty retail extracts derived from the benchmark tables.

Each text runs unchanged in Spark SQL (``{name}`` = a DataFrame) and, with ``"`` for backticks, in
DuckDB (``{name}`` = a view). Nothing depends on row order or chance, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_ORDERS = """
SELECT CASE WHEN l_suppkey % 97 = 0 AND l_linenumber > 1 THEN NULL
    ELSE 'ORD_' || cast(l_orderkey AS string) || '_' || cast(l_linenumber AS string) END AS `Order_ID`,
  CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'CUST' || cast(o_custkey AS string) END AS `cust_id`,
  CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 3 = 1 THEN 'hot product'
    ELSE p_name || ' ' || cast(p_partkey AS string) END AS `Product_Name`,
  CASE WHEN l_quantity = 1 THEN 'one' WHEN l_quantity = 2 THEN 'Two' WHEN l_quantity = 3 THEN 'three'
       WHEN l_suppkey % 13 = 0 THEN 'n/a' WHEN l_suppkey % 17 = 0 THEN NULL
       ELSE cast(cast(l_quantity AS int) AS string) END AS `Qty`,
  CASE l_suppkey % 8
    WHEN 0 THEN yy || '/' || mm || '/' || dd WHEN 1 THEN dd || '-' || mm || '-' || yy
    WHEN 2 THEN mm || '-' || dd || '-' || yy WHEN 3 THEN yy || '.' || mm || '.' || dd
    WHEN 4 THEN dd || '/' || mm || '/' || yy WHEN 5 THEN dd || '.' || mm || '.' || yy
    WHEN 6 THEN CASE mm WHEN '01' THEN 'January' WHEN '02' THEN 'February' WHEN '03' THEN 'March'
                WHEN '04' THEN 'April' WHEN '05' THEN 'May' WHEN '06' THEN 'June' WHEN '07' THEN 'July'
                WHEN '08' THEN 'August' WHEN '09' THEN 'September' WHEN '10' THEN 'October'
                WHEN '11' THEN 'November' ELSE 'December' END || ' ' || dd || ' ' || yy
    ELSE yy || '-' || mm || '-' || dd END AS `Order_Date`,
  CASE l_partkey % 6
    WHEN 0 THEN '$1,' || lpad(amt, 6, '0') || '.99' WHEN 1 THEN '₹' || amt WHEN 2 THEN 'Rs. ' || amt
    WHEN 3 THEN amt || ' USD' WHEN 4 THEN '₹ INR ' || amt ELSE '€' || amt END AS `Order_Amount$`,
  CASE l_suppkey % 5 WHEN 0 THEN 'DELIVERED-OK' WHEN 1 THEN 'In-Transit_123' WHEN 2 THEN 'pending/delayed'
    WHEN 3 THEN '123' ELSE NULL END AS `Delivery_Status`,
  CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'CREDIT_CARD' WHEN '2' THEN 'Debit-Card-123'
    WHEN '3' THEN 'UPI@456' WHEN '4' THEN 'Net Banking (RBI)' ELSE NULL END AS `Payment_Mode`,
  CASE o_custkey % 5 WHEN 0 THEN 'user' || cast(o_custkey AS string) || '+tag@domain.co.uk' WHEN 1 THEN 'invalid.email'
    WHEN 2 THEN 'john@' WHEN 3 THEN 'john.doe@example.com' ELSE 'john@domain' END AS `Email`,
  cast(l_suppkey AS string) || ' Main St. #Apt' || cast(l_linenumber AS string) || ' P@O Box!' AS `Ship_Address`,
  CASE WHEN l_discount > 0.05 THEN 'PROMO' ELSE NULL END AS `Promo_Code`,
  CASE l_linenumber % 4 WHEN 0 THEN 'bad' WHEN 1 THEN '4.5' WHEN 2 THEN '3' ELSE NULL END AS `Feedback_Score`
FROM (SELECT *, cast(year(o_orderdate) AS string) AS yy, lpad(cast(month(o_orderdate) AS string), 2, '0') AS mm,
        lpad(cast(day(o_orderdate) AS string), 2, '0') AS dd, cast(cast(floor(l_extendedprice) AS bigint) AS string) AS amt
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey) t
"""

RAW_RETURNS = """
SELECT CASE WHEN l_suppkey % 83 = 0 THEN NULL WHEN l_linenumber IN (3, 4) THEN 'RET-' || cast(l_orderkey AS string) || '-3'
    ELSE 'RET-' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string) END AS `Return_ID`,
  CASE WHEN l_suppkey % 3 = 1 THEN 'ORD_1_1' WHEN l_suppkey % 89 = 0 THEN NULL
    ELSE 'ORD_' || cast(l_orderkey AS string) || '_' || cast(l_linenumber AS string) END AS `Order_ID`,
  '  cust' || cast(l_suppkey AS string) || ' ' AS `Customer_ID`,
  CASE l_suppkey % 3 WHEN 0 THEN 'Damaged' WHEN 1 THEN 'User Changed Mind' ELSE 'Late' END AS `Return_Reason`,
  CASE l_suppkey % 4 WHEN 0 THEN dd || '/' || mm || '/' || yy WHEN 1 THEN dd || '.' || mm || '.' || yy
    WHEN 2 THEN dd || '-' || mm || '-' || yy ELSE '31-04-2025' END AS `Return_Date`,
  CASE l_partkey % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'in-progress' WHEN 2 THEN 'completed!' ELSE 'failed#123' END AS `Refund_Status`,
  '  WAREHOUSE#' || cast(l_suppkey AS string) || '  ' AS `Pickup_Address`,
  CASE l_partkey % 5 WHEN 0 THEN '$' || amt || '.99' WHEN 1 THEN '₹' || amt WHEN 2 THEN 'Rs. ' || amt || '.50'
    WHEN 3 THEN 'Refund $' || amt || ' of $150' ELSE 'Invalid data' END AS `Return_Amount`,
  '  PRODUCT#NAME-v' || cast(l_partkey AS string) || '  ' AS `Product`
FROM (SELECT *, cast(year(l_shipdate) AS string) AS yy, lpad(cast(month(l_shipdate) AS string), 2, '0') AS mm,
        lpad(cast(day(l_shipdate) AS string), 2, '0') AS dd, cast(cast(floor(l_extendedprice) AS bigint) AS string) AS amt
      FROM {lineitem} WHERE l_returnflag = 'R') t
"""

RAW_INVENTORY = """
SELECT CASE WHEN p_partkey <= 3 THEN 'hot product' ELSE p_name || ' ' || cast(p_partkey AS string) END AS `productName`,
  CASE p_partkey % 5 WHEN 0 THEN '$' || px || '.50' WHEN 1 THEN '₹' || px WHEN 2 THEN 'Rs. ' || px || '.25'
    WHEN 3 THEN px || ' USD' ELSE 'n/a' END AS `cost_price`,
  CASE p_size % 4 WHEN 0 THEN '2025/03/11' WHEN 1 THEN '2025.03.12' WHEN 2 THEN '2025-03-13' ELSE '2025-02-30' END AS `last_stocked`,
  CASE p_partkey % 9 WHEN 0 THEN 'twenty five' WHEN 1 THEN 'about twenty units' WHEN 2 THEN 'eighteen' WHEN 3 THEN 'fifteen'
    WHEN 4 THEN 'Twelve' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'twelve' ELSE cast(p_size AS string) END AS `stock`,
  CASE copy WHEN 1 THEN '  WAREHOUSE#1  ' ELSE 'warehouse-2@' END AS `warehouse`,
  CASE p_partkey % 8 WHEN 0 THEN 'YES' WHEN 1 THEN 'y' WHEN 2 THEN 'true' WHEN 3 THEN 'NO' WHEN 4 THEN 'n'
    WHEN 5 THEN 'false' WHEN 6 THEN 'maybe' ELSE NULL END AS `available`
FROM (SELECT *, cast(cast(floor(p_retailprice) AS bigint) AS string) AS px
      FROM (SELECT *, 1 AS copy FROM {part} UNION ALL SELECT *, 2 AS copy FROM {part} WHERE p_partkey % 10 = 0) u) t
"""

BASE_TABLES = ("lineitem", "orders", "part")


def _derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **tables)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, RAW_ORDERS)


def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, RAW_RETURNS)


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, RAW_INVENTORY)
