"""Each cleaning rule on documented examples and edge cases, with ANSI mode on and off."""

from __future__ import annotations

import datetime as dt
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailstrata.functions import cleaning as c

D = dt.date

CASES = {
    c.clean_quantity: [
        ("1", 1), ("one", 1), ("Two", 2), ("THREE", 3), ("n/a", None), (None, None), ("", None), (" one", None),
        (" 7 ", 7), ("1.9", 1), ("-2.5", -2), (".5", 0), ("1e3", None), ("2147483647", 2147483647),
        ("2147483648", None), ("four", None), ("1,000", None),
    ],
    c.clean_order_date: [
        ("2025/03/11", D(2025, 3, 11)), ("11-03-2025", D(2025, 3, 11)), ("03-11-2025", D(2025, 11, 3)),
        ("03-25-2025", D(2025, 3, 25)), ("2025.03.11", D(2025, 3, 11)), ("11/03/2025", D(2025, 3, 11)),
        ("11.03.2025", D(2025, 3, 11)), ("March 11 2025", D(2025, 3, 11)), ("march 11 2025", D(2025, 3, 11)),
        ("2025-03-11", None), ("31-04-2025", None), ("13-13-2025", None), ("1-4-2025", None), ("", None),
        (" 11-03-2025", None), ("25/25/2025", None), (None, None), ("not a date", None), ("29.02.2023", None),
    ],
    c.clean_amount: [
        ("$1,234.99", 123499.0), ("₹5000", 5000.0), ("Rs. 1250", 1250.0), ("100 USD", 100.0), ("₹ INR 500", 500.0),
        ("€5", None), ("", None), (None, None), ("-12", -12.0), ("$", None), ("1e2", 100.0), ("12abc", None),
    ],
    c.clean_amount_documented: [
        ("$1,234.99", 1234.99), ("₹5000", 5000.0), ("Rs. 1250", 1250.0), ("Rs. 1250.50", 1250.5),
        ("100 USD", 100.0), ("₹ INR 500", 500.0), ("€5", None), (None, None),
    ],
    c.clean_payment_mode: [
        ("CREDIT_CARD", "creditcard"), ("Debit-Card-123", "debitcard"), ("UPI@456", "upi"),
        ("Net Banking (RBI)", "netbankingrbi"), ("123", ""), (None, None), ("café", "caf"),
    ],
    c.clean_delivery_status: [
        ("IN-TRANSIT", "intransit"), ("Delivered_123", "delivered"), ("Pending/Delayed", "pendingdelayed"),
        ("RTO-FAILED#456", "rtofailed"), ("in transit", "in transit"), (" x\ty ", " xy "), ("123", ""), (None, None),
    ],
    c.clean_delivery_status_documented: [
        ("IN-TRANSIT", "in transit"), ("Delivered_123", "delivered"), ("Pending/Delayed", "pending delayed"),
        ("RTO-FAILED#456", "rto failed"), (None, None),
    ],
    c.valid_email: [
        ("john.doe@example.com", "john.doe@example.com"), ("user+tag@domain.co.uk", "user+tag@domain.co.uk"),
        ("invalid.email", None), ("john@", None), ("@example.com", None), ("john@domain", None), ("", None),
        (" a@b.co", None), (None, None),
    ],
    c.clean_ship_address: [
        ("123 Main St. #Apt1", "123 Main St. Apt1"), ("P@O Box 456", "PO Box 456"), ("Street$Name!", "StreetName"),
        ("123 @ Home #5", "123  Home 5"), (None, None),
    ],
    c.clean_feedback_score: [("4.5", 4.5), ("bad", None), ("", None), (None, None), (" 3 ", 3.0), ("NaN", math.nan)],
    c.clean_stock: [
        ("100", 100), ("0", 0), ("twenty five", 25), ("twenty", 20), ("about twenty units", 20), ("eighteen", 18),
        ("fifteen", 15), ("twelve", 12), ("twenty-five", 20), ("Twelve", None), ("unknown", None), ("", None),
        (None, None), ("-5", None), ("1.5", None), ("99999999999", None),
    ],
    c.clean_stock_documented: [("Twelve", 12), ("TWENTY FIVE", 25), ("100", 100), ("", None), (None, None)],
    c.clean_last_stocked: [
        ("2025/03/11", D(2025, 3, 11)), ("2025.03.11", D(2025, 3, 11)), ("2025-03-11", D(2025, 3, 11)),
        ("2025/03.11", D(2025, 3, 11)), ("2025-02-30", None), ("11-03-2025", None), ("", None), (None, None),
    ],
    c.clean_cost_price: [
        ("$99.99", 99.99), ("₹5000", 5000.0), ("Rs. 1250.50", 1250.5), ("100 USD", 100.0), ("€ 125.75", 125.75),
        ("Invalid123abc", 123.0), ("n/a", None), ("", None), (None, None), ("1,250.50", 1.0), ("-3.5", 3.5), ("7.", 7.0),
    ],
    c.clean_warehouse: [
        ("  WAREHOUSE#1  ", "Warehouse 1"), ("warehouse-2@", "Warehouse 2"), ("warehouse dubai", "Warehouse Dubai"),
        ("  warehouse  d  ", "Warehouse  D"), ("\twarehouse", "\twarehouse"), (None, None), ("", ""),
    ],
    c.clean_available: [
        ("YES", True), ("y", True), ("true", True), ("NO", False), ("n", False), ("False", False), ("maybe", None),
        ("1", None), (" yes", None), ("", None), (None, None),
    ],
    c.clean_return_date: [
        ("11/03/2025", D(2025, 3, 11)), ("11.03.2025", D(2025, 3, 11)), ("11-03-2025", D(2025, 3, 11)),
        ("31-04-2025", None), ("2025-03-11", None), ("", None), (None, None),
    ],
    c.clean_refund_status: [
        ("PENDING", "pending"), ("in-progress", "inprogress"), ("in progress", "inprogress"),
        ("completed!", "completed"), ("failed#123", "failed"), (None, None),
    ],
    c.clean_return_amount: [
        ("$1234.99", 1234.99), ("₹5000", 5000.0), ("Rs. 1250.50", 1250.5), ("100 USD", 100.0),
        ("Invalid data", None), ("Refund $100 of $150", 100.0), (None, None),
    ],
    c.clean_pickup_address: [("  WAREHOUSE#1  ", "Warehouse 1"), ("apt.5", "Apt 5"), ("123 main st", "123 Main St"), (None, None)],
    c.clean_product: [
        ("Product#1", "Product1"), ("item-name", "Itemname"), ("  PRODUCT#NAME-v2  ", "Productnamev2"),
        ("Model(Pro)", "Modelpro"), ("iphone 13", "Iphone 13"), (None, None),
    ],
    c.clean_product_documented: [("  PRODUCT#NAME-v2  ", "Product Name V2"), ("item-name", "Item Name"), (None, None)],
    c.clean_customer_id: [("  cust001  ", "CUST001"), ("CUST 001", "CUST 001"), ("Cst7", "CST7"), (None, None)],
    c.fix_customer_prefix: [
        ("CUST001", "CUST001"), ("CST001", "CUST001"), ("CT001", "CUST001"), ("CUSTOMER001", "CUSTOMER001"),
        ("X1", "X1"), ("", ""), (None, None),
    ],
}


def same(a, b) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def evaluate(spark, rule, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", rule(F.col("t")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("rule", CASES, ids=lambda r: r.__name__)
def test_rule(spark, ansi, rule):
    inputs = [i for i, _ in CASES[rule]]
    wrong = [(i, v, e) for (i, e), v in zip(CASES[rule], evaluate(spark, rule, inputs)) if not same(v, e)]
    assert not wrong, "input, got, expected"


ALL_CHARACTERS = [chr(i) for i in range(1, 0x250)] + ["₹", "€", " ", "　", "٣"]


@pytest.mark.parametrize(
    "fast, plain",
    [(c.NON_LETTER_OR_SPACE, r"[^a-zA-Z ]"), (c.NON_ALPHANUMERIC, r"[^a-zA-Z0-9\s]")],
)
def test_patterns_equal_their_plain_spelling(spark, fast, plain):
    df = spark.createDataFrame([(ch,) for ch in ALL_CHARACTERS], "t string")
    differing = df.where(F.regexp_replace("t", fast, "_") != F.regexp_replace("t", plain, "_"))
    assert differing.count() == 0


def test_stripping_by_translate_equals_the_character_class(spark):
    df = spark.createDataFrame([(f"1{ch}2{ch}",) for ch in ALL_CHARACTERS], "t string")
    differing = df.where(
        (F.translate("t", c.AMOUNT_NOISE, "") != F.regexp_replace("t", "[$₹Rs. USD, INR]", ""))
        | (F.translate("t", c.ADDRESS_NOISE, "") != F.regexp_replace("t", "[#@!$]", ""))
    )
    assert differing.count() == 0


DATE_PIECES = st.sampled_from(
    ["1", "01", "11", "12", "13", "31", "99", "2025", "+2025", "12025", "-", "/", ".", " ", "March", "May", "mar", "x", ""]
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(DATE_PIECES, max_size=7).map("".join), min_size=300, max_size=300))
def test_order_date_equals_trying_every_layout(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_date("t", fmt) for fmt in c.ORDER_DATE_FORMATS])
    assert df.where(~c.clean_order_date(F.col("t")).eqNullSafe(plain)).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. e\t\n", max_size=7), min_size=300, max_size=300))
def test_to_int_equals_the_lenient_cast(spark, texts):
    """ANSI mode off, a plain cast cuts fractions and gives null for bad text."""
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        bad = df.where(~c.to_int(F.col("t")).eqNullSafe(F.col("t").cast("int"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert not bad


def test_fixed_email_pattern_is_anchored():
    assert re.fullmatch(r"\^.*\$", c.EMAIL_PATTERN)


def test_texts_that_fail_are_not_tried(spark, monkeypatch):
    """A failed parse costs an exception a row; with casts that raise, these must pass through the rules."""
    column = type(F.col("x"))
    monkeypatch.setattr(column, "try_cast", column.cast)
    monkeypatch.setattr(F, "try_to_date", F.to_date)
    cases = {
        c.clean_order_date: {"12-31-2024": "2024-12-31", "31-12-2024": "2024-12-31", "31/04/2024": None, "2024.02.30": None, "00-00-2024": None},
        c.clean_return_date: {"31-04-2025": None, "30.04/2025": "2025-04-30", "28.02.2025": "2025-02-28"},
        c.clean_last_stocked: {"2025-02-30": None, "2025/03/11": "2025-03-11"},
        c.clean_amount: {"€5": None, "$1,000123.99": "1.00012399E8", "Rs.": None},
        c.clean_return_amount: {"Invalid data": None, "Refund $7.5 of $150": "7.5"},
        c.clean_feedback_score: {"bad": None, "4.5": "4.5", "nan": "NaN"},
        c.clean_quantity: {"n/a": None, "Two": "2", "1.9": "1"},
    }
    for rule, values in cases.items():
        df = spark.createDataFrame([(k,) for k in values], "c string").select("c", rule(F.col("c")).cast("string").alias("v"))
        assert {r["c"]: r["v"] for r in df.collect()} == values, rule.__name__


def test_plain_dates_are_those_of_the_formatter(spark, ansi):
    texts = [
        f"{lead}{s.join(parts)}{tail}"
        for y in ("2024", "1900", "0000", "12024", "24") for m in ("02", "12", "13", "00", "1") for d in ("29", "30", "31", "12", "00")
        for parts in ((y, m, d), (d, m, y), (m, d, y)) for s in "-/." for lead in ("", " ") for tail in ("", "\n", " 1")
    ]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    text = F.col("c")
    tried = F.coalesce(*[F.try_to_date(text, x) for x in c.ORDER_DATE_FORMATS])
    returned = F.try_to_date(F.translate(text, "/.", "--"), c.RETURN_DATE_FORMAT)
    found = df.select("c", c.clean_order_date(text).alias("a"), tried.alias("b"), c.clean_return_date(text).alias("x"), returned.alias("y"))
    assert found.where("not (a <=> b) or not (x <=> y)").collect() == []
    assert found.where("a is not null").count() > 50


def test_amount_rules_work_on_a_text_once():
    """A rule that tests what it has made of a text makes it twice for every row."""
    x = F.col("x")
    assert str(c.clean_amount(x)).count("translate(") == 1
    assert str(c.first_number(x)).count("regexp_extract(") == 1


def test_amount_rules_test_the_text_as_its_rest(spark, ansi):
    pieces = ["", "5", "07", ".", "n", "N", "nan", "inf", "INR", "₹", "€", "-", " ", "\n", "e3", "٣", "1,0", "9" * 400]
    df = spark.createDataFrame([(a + b + d,) for a in pieces for b in pieces for d in pieces], "t string")
    t = F.col("t")
    amount, number = c.to_double(F.translate(t, c.AMOUNT_NOISE, "")), c.to_double(F.regexp_extract(t, c.FIRST_NUMBER_PATTERN, 1))
    found = df.select("t", c.clean_amount(t).alias("a"), amount.alias("b"), c.first_number(t).alias("x"), number.alias("y"))
    assert found.where("not (a <=> b) or not (x <=> y)").collect() == []
    assert found.where("a is not null and x is not null").count() > 500


def test_last_days_of_months(spark, ansi):
    """Day-first and month-first layouts take the 29th to 31st of the months that have them, as a formatter does."""
    texts = [f"{a:02d}{s}{b:02d}{s}{y}" for a in range(33) for b in range(33) for s in "-/." for y in (2023, 2024)]
    text = F.col("c")
    tried = F.coalesce(*[F.try_to_date(text, x) for x in c.ORDER_DATE_FORMATS])
    df = spark.createDataFrame([(t,) for t in texts], "c string").select("c", c.clean_order_date(text).alias("a"), tried.alias("b"))
    assert df.where("not (a <=> b)").collect() == []
