"""Trend marts (TR1-TR7) over delivered sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.common import delivered, facts, mean_of, non_null_key, pct_change, sum_d, total


def monthly_trend(clean: DataFrame) -> DataFrame:
    """TR1 + TR2: revenue, orders, avg value per month, and MoM growth % of the rounded revenue."""
    d = non_null_key(delivered(facts(clean)), "year", "month", "month_name")
    m = d.groupBy("year", "month", "month_name").agg(
        F.bround(sum_d("total_amount"), 2).alias("revenue"),
        total("n_orders").alias("orders"),
        F.bround(mean_of("total_amount", "n_amounts"), 2).alias("avg_val"),
    )
    w = Window.orderBy("year", "month")  # one row per month: a tiny window
    return m.withColumn("mom_growth_pct", F.bround(pct_change("revenue", w) * F.lit(100.0), 2)).orderBy("year", "month")


def category_trend(clean: DataFrame) -> DataFrame:
    """TR3: delivered revenue per (year, month, category)."""
    d = non_null_key(delivered(facts(clean)), "year", "month", "category")
    return d.groupBy("year", "month", "category").agg(F.bround(sum_d("total_amount"), 2).alias("revenue"))


def region_trend(clean: DataFrame) -> DataFrame:
    """TR4: revenue, orders, avg value per region, by revenue descending."""
    d = non_null_key(delivered(facts(clean)), "region")
    g = d.groupBy("region").agg(
        F.bround(sum_d("total_amount"), 2).alias("revenue"),
        total("n_orders").alias("orders"),
        F.bround(mean_of("total_amount", "n_amounts"), 2).alias("avg_val"),
    )
    return g.orderBy(F.col("revenue").desc(), "region")


def weekend_vs_weekday(clean: DataFrame) -> DataFrame:
    """TR5: revenue and orders for weekend vs weekday, with a label."""
    d = non_null_key(delivered(facts(clean)), "is_weekend")
    g = d.groupBy("is_weekend").agg(sum_d("total_amount").alias("revenue"), total("n_orders").alias("orders"))
    return g.withColumn("label", F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday"))


def category_share(clean: DataFrame) -> DataFrame:
    """TR6: TR3 rolled up by category, with its share of the total (1 decimal, as in the pie)."""
    # TR3's revenues are exact 2-decimal sums, so rolling them up equals the
    # exact decimal sum per category; the total is exact too (order-independent).
    d = non_null_key(delivered(facts(clean)), "year", "month", "category")
    cat = d.groupBy("category").agg(F.sum("total_amount").alias("rev_dec"))
    whole = cat.agg(F.sum("rev_dec").alias("_total"))  # one row: broadcast is bounded
    return cat.crossJoin(F.broadcast(whole)).select(
        "category",
        F.col("rev_dec").cast("double").alias("revenue"),
        F.bround(F.try_divide(F.col("rev_dec").cast("double"), F.col("_total").cast("double")) * 100.0, 1).alias("share_pct"),
    )


def last_months(clean: DataFrame, n: int = 6) -> DataFrame:
    """TR7: the last ``n`` months of TR1/TR2 (top-n by (year, month) desc; a per-partition top-k)."""
    m = monthly_trend(clean)
    return m.orderBy(F.col("year").desc(), F.col("month").desc()).limit(n).select(
        "year", "month", "month_name", "revenue", "mom_growth_pct"
    )


__all__ = [
    "category_share",
    "category_trend",
    "last_months",
    "monthly_trend",
    "region_trend",
    "weekend_vs_weekday",
]
