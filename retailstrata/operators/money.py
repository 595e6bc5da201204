"""Sums of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ten decimal places leave 28 digits before the point.
EXACT = "decimal(38,10)"


def money(amount: Column) -> Column:
    """Sum of a double column as double, null without values.

    Amounts are added as decimals, so the order of addition does not show. Should an amount, or the sum, be too
    large for that, the doubles themselves are added; nothing is left out or becomes null. Each amount is rounded to
    ten places first, so less than half of that adds nothing.
    """
    exact = amount.try_cast(EXACT)
    total = F.try_sum(exact).cast("double")
    return F.coalesce(F.when(F.count(exact) == F.count(amount), total), F.sum(amount))


# The same sum in parts that can be stored and added up later: amounts, amounts that fit, exact sum, sum of doubles.
PARTS = ("values", "fits", "exact", "double")


def money_parts(amount: Column, name: str, plus: Column | None = None) -> list[Column]:
    """The parts of ``money`` as columns ``name_...``. ``plus``: false for amounts to take off."""
    exact, one = amount.try_cast(EXACT), F.lit(1)
    if plus is not None:
        exact, amount, one = (F.when(plus, x).otherwise(-x) for x in (exact, amount, one))
    parts = {
        "values": F.sum(F.when(amount.isNotNull(), one).otherwise(0)),
        "fits": F.sum(F.when(exact.isNotNull(), one).otherwise(0)),
        "exact": F.try_sum(exact),
        "double": F.sum(amount),
    }
    return [parts[p].alias(f"{name}_{p}") for p in PARTS]


def added_parts(name: str) -> list[Column]:
    """Parts of several sums added up."""
    # An exact sum that did not fit is null, and so is every total with it.
    lost = F.count(F.when(F.col(f"{name}_exact").isNull() & (F.col(f"{name}_fits") != 0), 1))
    parts = {p: F.sum(f"{name}_{p}") for p in PARTS} | {"exact": F.when(lost == 0, F.try_sum(f"{name}_exact"))}
    return [parts[p].alias(f"{name}_{p}") for p in PARTS]


def money_of(name: str) -> Column:
    """The sum as ``money`` gives it."""
    exact = F.when(F.col(f"{name}_fits") == F.col(f"{name}_values"), F.col(f"{name}_exact").cast("double"))
    return F.when(F.col(f"{name}_values") > 0, F.coalesce(exact, F.col(f"{name}_double")))
