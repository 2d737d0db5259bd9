"""Simple projections.

All of these run on the monthly (or daily) roll-ups, which are bounded by
the calendar, not by the number of sales; the roll-ups themselves are
ordinary distributed group-bys over the cleaned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.common import delivered, monthly_revenue, non_null_key, pct_change, sum_d


def daily_revenue(clean: DataFrame) -> DataFrame:
    """delivered revenue per day as (ds, y)."""
    d = non_null_key(delivered(clean), "sale_date")
    return d.groupBy(F.col("sale_date").alias("ds")).agg(sum_d("total_amount").alias("y"))


def future_dates(series: DataFrame, days: int, key_cols: tuple[str, ...] = ()) -> DataFrame:
    """The ``days`` calendar days after the last ``ds`` of each series."""
    last = series.groupBy(*key_cols).agg(F.max("ds").alias("_last"))
    seq = F.sequence(F.date_add("_last", 1), F.date_add("_last", days))
    return last.select(*key_cols, F.explode(seq).alias("ds"))


def prediction_dates(series: DataFrame, days: int, key_cols: tuple[str, ...] = ()) -> DataFrame:
    """the days of each series' history and the ``days`` calendar days after them (``is_future``)."""
    past = series.select(*key_cols, "ds").withColumn("is_future", F.lit(False))
    return past.unionByName(future_dates(series, days, key_cols).withColumn("is_future", F.lit(True)))


def _tail_stats(m: DataFrame, growth_default: float) -> DataFrame:
    """F6/F7 from a monthly table (year, month, revenue)."""
    w = Window.orderBy("year", "month")  # one row per month present
    m = m.withColumn("chg", pct_change("revenue", w)).withColumn(
        "rk", F.row_number().over(Window.orderBy(F.col("year").desc(), F.col("month").desc()))
    )
    agg = m.agg(
        F.count(F.lit(1)).alias("n_months"),
        F.avg(F.when(F.col("rk") <= 3, F.col("revenue"))).alias("last_3_avg"),
        F.max(F.when(F.col("rk") == 1, F.col("revenue"))).alias("last_month"),
        F.avg(F.when(F.col("rk") <= 3, F.col("chg"))).alias("tail_growth"),
    )
    # "mean or default": 0 falls back to the default; no months -> default too
    g = F.when(
        F.col("n_months") >= 2,
        F.coalesce(F.when(F.col("tail_growth") != 0, F.col("tail_growth")), F.lit(growth_default)),
    ).otherwise(F.lit(growth_default))
    return agg.select(
        "n_months",
        F.coalesce(F.col("last_3_avg"), F.lit(0.0)).alias("last_3_avg"),
        F.coalesce(F.col("last_month"), F.lit(0.0)).alias("last_month"),
        g.alias("growth"),
    )


def revenue_projection(clean: DataFrame, growth_default: float = S.DEFAULT_GROWTH) -> DataFrame:
    """Last-3-month mean, last month, growth, next month and next quarter projections."""
    t = _tail_stats(monthly_revenue(clean), growth_default)
    lm, g = F.col("last_month"), F.col("growth")
    nq = lm * (1 + g) + lm * F.pow(1 + g, 2) + lm * F.pow(1 + g, 3)
    # presentation rounding: money to 2 decimals, growth to 6
    return t.select(
        F.bround("last_3_avg", 2).alias("last_3_avg"),
        F.bround("last_month", 2).alias("last_month"),
        F.bround("growth", 6).alias("growth"),
        F.bround(lm * (1 + g), 2).alias("forecast_next_month"),
        F.bround(nq, 2).alias("forecast_next_quarter"),
    )


def category_projection(clean: DataFrame, growth_default: float = S.DEFAULT_GROWTH) -> DataFrame:
    """per category, last present month's revenue and a projection with its mean MoM change.

    The mean is over all of the category's month-to-month changes; with one
    month, or a mean of exactly 0, the overall growth (F7) is used instead.
    """
    d = non_null_key(delivered(clean), "category", "year", "month")
    m = d.groupBy("category", "year", "month").agg(sum_d("total_amount").alias("revenue"))
    w = Window.partitionBy("category").orderBy("year", "month")
    m = m.withColumn("chg", pct_change("revenue", w))
    per = m.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_months"),
        F.max_by("revenue", F.struct("year", "month")).alias("last_month_rev"),
        F.avg("chg").alias("mean_chg"),
    )
    overall = _tail_stats(monthly_revenue(clean), growth_default).select(F.col("growth").alias("overall_growth"))
    per = per.crossJoin(F.broadcast(overall))  # one-row scalar
    cat_g = F.when(
        F.col("n_months") >= 2,
        F.coalesce(F.when(F.col("mean_chg") != 0, F.col("mean_chg")), F.col("overall_growth")),
    ).otherwise(F.col("overall_growth"))
    per = per.withColumn("growth", cat_g)
    return per.select(
        "category",
        F.bround("last_month_rev", 2).alias("last_month_rev"),
        F.bround("growth", 6).alias("growth"),
        F.bround(F.col("last_month_rev") * (1 + F.col("growth")), 2).alias("projected_rev"),
    )
