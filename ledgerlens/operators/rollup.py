"""Additive roll-up of the cleaned sales, and mergeable customer sketches by month.

One row per day, category, region and status (and the calendar columns of the
day) holds the sums and counts from which the additive marts (K1, K2, K4-K11,
TR, I, F1, F6-F9, R1-R3, R5-R10) are computed: ``common.facts`` gives the same
columns to a table of single sales, so a mart takes either. Its size follows
calendar x categories x regions, not the number of sales. Sums are DECIMAL, so
marts from it equal those from the sales to the last digit.

Both tables are partitioned by month. ``refresh`` recomputes some months from
the cleaned table and replaces just their partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.common import COUNTS, facts
from ledgerlens.sources import files

KEYS = ("sale_date", "category", "region", "order_status", "year", "month", "month_name", "quarter", "day_of_week", "is_weekend")
SUMS = ("total_amount", "discount_amt", "discount_pct")
#: Registers of a customer sketch, as a power of two; the relative standard error is 1.04 / sqrt(2**SKETCH_BITS), 0.8 %.
SKETCH_BITS = 14

Months = list[tuple[int, int]]


def sales_rollup(clean: DataFrame) -> DataFrame:
    """Sums and counts by day, category, region and status."""
    return facts(clean).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in (*SUMS, *COUNTS)])


def write(clean: DataFrame, path: str) -> int:
    """Replace the roll-up; returns its rows."""
    return files.write_table(sales_rollup(clean).hint("rebalance", "year", "month"), path, partition_by=("year", "month"))


def customer_sketches(clean: DataFrame) -> DataFrame:
    """year, month, sketch: distinct customers (all statuses) in mergeable form."""
    return clean.groupBy("year", "month").agg(F.hll_sketch_agg("customer_email", F.lit(SKETCH_BITS)).alias("sketch"))


def approx_customers(sketches: DataFrame) -> DataFrame:
    """K3 from the sketches of any set of months: total_customers (approximate), one row."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("long").alias("total_customers"))


def _in_months(df: DataFrame, months: Months) -> DataFrame:
    some = F.lit(False)
    for y, m in months:
        some = some | ((F.col("year") == y) & (F.col("month") == m))
    return df.where(some)


def refresh(clean: DataFrame, path: str, months: Months) -> None:
    """Recompute the roll-up of some months and replace their partitions; the others are not read.

    A month that has no sales any more keeps a row of zeros, which adds
    nothing, so that its old partition goes.
    """
    spark: SparkSession = clean.sparkSession
    fresh = sales_rollup(_in_months(clean, months))
    zeros = spark.createDataFrame(months, "year int, month int").withColumns({c: F.lit(0) for c in COUNTS})
    fresh = fresh.unionByName(zeros.withColumns({c: F.col(c).cast("long") for c in COUNTS}), allowMissingColumns=True)
    target = files.table_path(spark, path)
    columns = spark.read.parquet(target).columns
    out = fresh.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("year", "month").parquet(target)
