"""Cleaning rules for dirty retail columns, each one a ``Column -> Column`` function.

Every rule is a plain built-in expression: no UDF, so a chain of rules stays inside one
whole-stage-codegen span. Failed parses become null through ``try_cast`` / ``try_to_date``, so the
rules give the same values with ``spark.sql.ansi.enabled`` on or off.

Rules whose worked examples disagree with what the pipeline computes have a second function with
the suffix ``_documented`` that gives the documented value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the original pipeline's for the results to match.
QUANTITY_WORDS = {"one": 1, "two": 2, "three": 3}
STOCK_WORDS = {"twenty five": 25, "twenty": 20, "eighteen": 18, "fifteen": 15, "twelve": 12}
ORDER_DATE_FORMATS = (
    "yyyy/MM/dd",
    "dd-MM-yyyy",
    "MM-dd-yyyy",
    "yyyy.MM.dd",
    "dd/MM/yyyy",
    "dd.MM.yyyy",
    "MMMM dd yyyy",
)
STOCKED_DATE_FORMAT = "yyyy-MM-dd"
RETURN_DATE_FORMAT = "dd-MM-yyyy"
AMOUNT_NOISE = "$₹Rs. USD, INR"
ADDRESS_NOISE = "#@!$"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
FIRST_NUMBER_PATTERN = r"(\d+\.?\d*)"
DIGITS_PATTERN = r"^[0-9]+$"
NON_LETTER = "[^a-zA-Z]"
# The next two equal [^a-zA-Z ] and [^a-zA-Z0-9\s]. With the exceptions in a lookahead they run 5 to 7
# times faster: the regex engine's matcher for a class of three or more parts is not inlined.
NON_LETTER_OR_SPACE = "(?! )[^a-zA-Z]"
NON_ALPHANUMERIC = r"(?![0-9\s])[^a-zA-Z]"
AVAILABLE_YES = ("yes", "y", "true")
AVAILABLE_NO = ("no", "n", "false")
CUSTOMER_PREFIX = "CUST"
CUSTOMER_PREFIX_TYPOS = ("CST", "CT")

# A number with a fractional part, surrounded by what a string-to-number cast trims.
_FRACTIONAL_NUMBER = r"^[\x00-\x20\x7f]*([+-]?)([0-9]*)\.[0-9]*[\x00-\x20\x7f]*$"


def to_int(c: Column) -> Column:
    """String to int; "1.9" is cut to 1, text that is no int32 number is null.

    ``try_cast`` alone refuses fractions, so they are cut off first ("-.5" -> "-0" -> 0). A failed cast costs an
    exception, so texts without a digit are not tried.
    """
    whole = F.when(c.contains("."), F.regexp_replace(c, _FRACTIONAL_NUMBER, "$10$2")).otherwise(c)
    return F.when(c.rlike("[0-9.]"), whole.try_cast("int"))


def to_double(c: Column) -> Column:
    """String to double; text that is no number is null.

    A failed cast costs an exception, so texts with other than ASCII characters, or without a digit or the "n" of "nan"
    and "inf", are not tried.
    """
    return F.when(c.rlike(r"^[\x00-\x7f]*[0-9nN][\x00-\x7f]*\z"), c.try_cast("double"))


def plain_date(c: Column, layout: str, separators: str) -> tuple[Column, Column]:
    """Whether a text has the digits of a numeric layout with some of the separators, and its date, null if there is none.

    A formatter takes several times longer than a cast. Both throw an exception for a day that the month does not have, so
    such days are not tried. Year 0000, which only the cast knows, counts as another text.
    """
    digits = {"yyyy": "(?!0000)[0-9]{4}", "MM": "[0-9]{2}", "dd": "[0-9]{2}"}
    parts = sorted(digits, key=layout.index)
    pattern = "^" + f"[{separators}]".join(digits[p] for p in parts) + r"\z"
    texts = {p: F.substring(c, layout.index(p) + 1, len(p)) for p in digits}
    month, day = texts["MM"], texts["dd"]
    last = F.when(month == "02", "29").when(month.isin("04", "06", "09", "11"), "30").otherwise("31")
    # Every month has 28 days; only later days are held against their month's last.
    there = month.between("01", "12") & (day >= "01") & ((day <= "28") | (day <= last))
    return c.rlike(pattern), F.when(there, F.concat_ws("-", *texts.values()).try_cast("date"))


def first_number(c: Column) -> Column:
    """First unsigned decimal number in the text; null when there is none.

    A text with a digit has one that a cast reads. The test is made on the text, as one on the extracted number would have
    the number extracted twice.
    """
    return F.when(c.rlike("[0-9]"), F.regexp_extract(c, FIRST_NUMBER_PATTERN, 1).try_cast("double"))


def letters_only(c: Column) -> Column:
    """Lower-cased ASCII letters of the text, everything else removed."""
    return F.lower(F.regexp_replace(c, NON_LETTER, ""))


def title_text(c: Column, symbol_to: str = " ") -> Column:
    """Replace symbols by ``symbol_to``, trim spaces, capitalise each word."""
    return F.initcap(F.trim(F.regexp_replace(c, NON_ALPHANUMERIC, symbol_to)))


def _first_match(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    chain = reduce(lambda acc, case: acc.when(*case), cases, F)
    return chain.otherwise(otherwise)


# --- orders -------------------------------------------------------------------------------------


def clean_quantity(c: Column) -> Column:
    """Number words to integers, other text cast to int."""
    words = [(F.lower(c) == word, F.lit(n)) for word, n in QUANTITY_WORDS.items()]
    return _first_match(words, to_int(c))


def clean_order_date(c: Column) -> Column:
    """First layout that parses, in the order of ``ORDER_DATE_FORMATS`` (day-first before month-first).

    A failed parse is the costly part, so each text only meets the layouts its separators allow:
    days and months are two digits and years at least four, hence a separator in third place tells
    the day- or month-first layouts from the year-first ones.
    """
    third = F.substring(c, 3, 1)
    layouts: dict[tuple[bool, str], list[str]] = {}
    for layout in ORDER_DATE_FORMATS:
        separator = next(x for x in layout if not x.isalpha())
        layouts.setdefault((layout[2] == separator, separator), []).append(layout)
    cases = [
        (third == separator if in_third else c.contains(separator), _first_date(c, own, separator))
        for (in_third, separator), own in sorted(layouts.items(), key=lambda item: not item[0][0])
    ]
    return _first_match(cases, F.lit(None).cast("date"))


def _first_date(c: Column, layouts: list[str], separator: str) -> Column:
    """First layout that parses, of layouts whose digits stand in the same places."""
    parsed = F.coalesce(*[F.try_to_date(c, x) for x in layouts])
    if not all(len(x) == 10 for x in layouts):
        return parsed
    plain = [plain_date(c, x, separator) for x in layouts]
    return F.when(plain[0][0], F.coalesce(*[date for _, date in plain])).otherwise(parsed)


def clean_amount(c: Column) -> Column:
    """Drop currency marks, separators *and the decimal point*, then cast to double.

    The test of ``to_double`` is made on the text before, as one on the rest would have the marks dropped twice. Of the
    letters of "nan" and "inf" only the small "n" is left.
    """
    there = c.rlike(r"^[\x00-\x7f₹]*[0-9n][\x00-\x7f₹]*\z")
    return F.when(there, F.translate(c, AMOUNT_NOISE, "").try_cast("double"))


def clean_amount_documented(c: Column) -> Column:
    """Drop currency marks and thousands commas, keep the decimal point."""
    return to_double(F.regexp_replace(c, r"Rs\.?|USD|INR|[$₹,\s]", ""))


def clean_payment_mode(c: Column) -> Column:
    return letters_only(c)


def clean_delivery_status(c: Column) -> Column:
    """Lower-cased letters and spaces; separators vanish ("In-Transit" -> "intransit")."""
    return F.lower(F.regexp_replace(c, NON_LETTER_OR_SPACE, ""))


def clean_delivery_status_documented(c: Column) -> Column:
    """Separators become one space ("In-Transit" -> "in transit")."""
    return F.lower(F.trim(F.regexp_replace(c, "[^a-zA-Z]+", " ")))


def valid_email(c: Column) -> Column:
    """The address when it is well formed, else null."""
    return F.when(c.rlike(EMAIL_PATTERN), c)


def clean_ship_address(c: Column) -> Column:
    return F.translate(c, ADDRESS_NOISE, "")


def clean_feedback_score(c: Column) -> Column:
    return to_double(c)


# --- inventory ----------------------------------------------------------------------------------


def _stock_from_words(c: Column) -> Column:
    return _first_match(
        [(c.contains(word), F.lit(n)) for word, n in STOCK_WORDS.items()], F.lit(None).cast("int")
    )


def clean_stock(c: Column) -> Column:
    """Digits to int; otherwise the first known number word in the text (case-sensitive); else null."""
    return F.when(c.rlike(DIGITS_PATTERN), c.try_cast("int")).otherwise(_stock_from_words(c))


def clean_stock_documented(c: Column) -> Column:
    """As ``clean_stock`` with number words in any case."""
    return clean_stock(F.lower(c))


def clean_last_stocked(c: Column) -> Column:
    """Year-first date with ``/``, ``.`` or ``-`` between the parts."""
    there, date = plain_date(c, STOCKED_DATE_FORMAT, "/.-")
    return F.when(there, date).otherwise(F.try_to_date(F.translate(c, "/.", "--"), STOCKED_DATE_FORMAT))


def clean_cost_price(c: Column) -> Column:
    return first_number(c)


def clean_warehouse(c: Column) -> Column:
    return title_text(c)


def clean_available(c: Column) -> Column:
    """Yes words to true, no words to false, anything else null."""
    answer = F.lower(c)
    return F.when(answer.isin(*AVAILABLE_YES), True).when(answer.isin(*AVAILABLE_NO), False)


# --- returns ------------------------------------------------------------------------------------


def clean_return_date(c: Column) -> Column:
    """Day-first date with ``/``, ``.`` or ``-`` between the parts."""
    there, date = plain_date(c, RETURN_DATE_FORMAT, "/.-")
    return F.when(there, date).otherwise(F.try_to_date(F.translate(c, "/.", "--"), RETURN_DATE_FORMAT))


def clean_refund_status(c: Column) -> Column:
    return letters_only(c)


def clean_return_amount(c: Column) -> Column:
    return first_number(c)


def clean_pickup_address(c: Column) -> Column:
    return title_text(c)


def clean_product(c: Column) -> Column:
    """Symbols vanish ("item-name" -> "Itemname")."""
    return title_text(c, symbol_to="")


def clean_product_documented(c: Column) -> Column:
    """Symbols become spaces ("item-name" -> "Item Name")."""
    return title_text(c)


def clean_customer_id(c: Column) -> Column:
    return F.trim(F.upper(c))


def fix_customer_prefix(c: Column) -> Column:
    """Put the standard prefix in place of its known misspellings."""
    typos = [
        (c.startswith(typo), F.concat(F.lit(CUSTOMER_PREFIX), F.substring(c, len(typo) + 1, 2**31 - 1)))
        for typo in CUSTOMER_PREFIX_TYPOS
    ]
    return _first_match([(c.startswith(CUSTOMER_PREFIX), c), *typos], c)
