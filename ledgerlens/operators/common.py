"""Shared building blocks for the marts: delivered filter, exact means, monthly roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S


def delivered(clean: DataFrame) -> DataFrame:
    """Rows with order_status = 'Delivered' (pushed to the scan when reading the cleaned table)."""
    return clean.where(F.col("order_status") == S.STATUS_DELIVERED)


# Counts of a table of facts: rows, and the non-NULL values of the columns that are counted or averaged.
COUNTS = {"n_rows": None, "n_orders": "order_id", "n_amounts": "total_amount", "n_discounts": "discount_pct"}


def facts(sales: DataFrame) -> DataFrame:
    """Sales with their counts: a roll-up has them already, a table of single sales gets 1 or 0 each."""
    if "n_rows" in sales.columns:
        return sales
    one = F.lit(1).cast("long")
    return sales.withColumns({n: one if c is None else F.when(F.col(c).isNotNull(), one).otherwise(F.lit(0).cast("long")) for n, c in COUNTS.items()})


def total(n: str, where: Column | None = None) -> Column:
    """Sum of a count of facts, 0 without rows."""
    return F.coalesce(F.sum(F.col(n) if where is None else F.when(where, F.col(n))), F.lit(0)).cast("long")


def sum_d(c: str) -> Column:
    """Exact decimal sum returned as DOUBLE."""
    return F.sum(c).cast("double")


def mean_d(c: str) -> Column:
    """Mean of single sales as CAST(SUM AS DOUBLE) / COUNT, the same numbers every engine divides."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def mean_of(c: str, n: str) -> Column:
    """Mean of a column of facts, whose non-NULL values are counted by ``n``."""
    return F.try_divide(F.sum(c).cast("double"), total(n).cast("double"))


def non_null_key(df: DataFrame, *keys: str) -> DataFrame:
    """pandas group-by drops NULL keys; Spark keeps a NULL group."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def monthly_revenue(clean: DataFrame) -> DataFrame:
    """Delivered revenue per (year, month), exact DOUBLE, one row per month present."""
    d = non_null_key(delivered(facts(clean)), "year", "month")
    return d.groupBy("year", "month").agg(sum_d("total_amount").alias("revenue"), total("n_orders").alias("orders"))


def pct_change(c: str, w: Window) -> Column:
    """pandas pct_change: x / previous - 1 (previous present row; NULL for the first row or a zero previous)."""
    return F.try_divide(F.col(c), F.lag(c).over(w)) - F.lit(1.0)
