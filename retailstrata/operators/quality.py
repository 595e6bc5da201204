"""Row checks and enrichments on silver returns. Limits, dates and word lists are arguments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The refund statuses expected after cleaning, and the amount above which to review.
REFUND_STATUSES = ("pending", "inprogress", "completed", "rejected", "cancelled", "initiated")
REVIEW_AMOUNT = 1000


def with_order_date(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Returns with the OrderDate of their order (null without one). Orders are unique by OrderID.

    The orders are joined by an expression: read from buckets of OrderID they would not be shuffled, and then
    the returns of an order with very many of them could not be split either.
    """
    dates = orders.select(F.concat("OrderID", F.lit("")).alias("__order"), "OrderDate")
    return returns.join(dates, returns["OrderID"] == F.col("__order"), "left").drop("__order")


def return_checks(today: dt.date) -> dict[str, Column]:
    """Conditions a return with a known order date should meet; null where a value is missing."""
    return {
        "AmountPositive": F.col("ReturnAmount") > 0,
        "DateNotInFuture": F.col("ReturnDate") <= F.lit(today),
        "DateAfterOrder": F.col("ReturnDate") > F.col("OrderDate"),
    }


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: the number of rows, and per check how many rows break it (unknown is no break)."""
    return df.agg(
        F.count(F.lit(1)).alias("Rows"), *[F.count(F.when(~ok, 1)).alias(name) for name, ok in checks.items()]
    )


def judged(df: DataFrame, checks: Mapping[str, Column], counts: Observation | None = None) -> DataFrame:
    """Every row with ``Reject_Reasons``, the names of the checks it breaks, and ``Rejected``: whether there are any.

    A check on a missing value is not broken. With ``counts`` the numbers of ``violations`` and of ``Rejected`` rows are
    taken while the rows are written, and need no read of their own.
    """
    broken = [F.when(~ok, F.lit(name)) for name, ok in checks.items()]
    out = df.withColumn("Reject_Reasons", F.array_compact(F.array(*broken)))
    out = out.withColumn("Rejected", F.size("Reject_Reasons") > 0)
    if counts is None:
        return out
    each = [F.count(F.when(F.array_contains("Reject_Reasons", name), 1)).alias(name) for name in checks]
    return out.observe(counts, F.count(F.lit(1)).alias("Rows"), *each, F.count(F.when(F.col("Rejected"), 1)).alias("Rejected"))


def outside_list(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """How often each value that is not in the list occurs (null counts as such a value)."""
    known = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(~known).groupBy(column).agg(F.count(F.lit(1)).alias("Rows"))


def unknown_statuses(returns: DataFrame) -> DataFrame:
    """How often each refund status occurs that is not expected after cleaning."""
    return outside_list(returns, "RefundStatus", REFUND_STATUSES)


def map_values(c: Column, mapping: Mapping[str, str]) -> Column:
    """Standard form of a value; values without an entry stay."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.coalesce(table[c], c)


def days_to_return() -> Column:
    return F.datediff("ReturnDate", "OrderDate")


def high_value(limit: float = REVIEW_AMOUNT) -> Column:
    """Whether a return should be reviewed; a return without a readable amount is not flagged."""
    return F.coalesce(F.col("ReturnAmount") > limit, F.lit(False))
