"""Data quality checks (V1-V7) as one conditional aggregate plus one group-by.

The checks table has one row per check: ``check``, ``violations`` and
``passed``; the score is the share of passed checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.labels import quality_band
from ledgerlens.operators.cleaning import as_of_col

CRITICAL = ("order_id", "total_amount", "sale_date", "category", "region")


def _duplicates(df: DataFrame) -> DataFrame:
    """V2: rows beyond the first per order_id (NULL ids form one group, as pandas ``duplicated``)."""
    g = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("dupes"))


def checks(df: DataFrame, params: S.Params) -> DataFrame:
    """V1-V6: the ten checks as rows (check, violations, passed)."""
    allowed = F.col("category").isin(*params.allowed_categories)
    aggs: list[Column] = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL]
    aggs += [
        F.count_if(F.col("total_amount") <= 0).alias("non_positive"),
        F.count_if(F.col("sale_date") > as_of_col(params)).alias("future"),
        F.count_if(~F.coalesce(allowed, F.lit(False))).alias("bad_category"),
        F.count(F.lit(1)).alias("rows"),
    ]
    wide = df.agg(*aggs).crossJoin(_duplicates(df))
    items = [F.struct(F.lit(f"No nulls in '{c}'").alias("check"), F.col(f"null_{c}").alias("violations"), (F.col(f"null_{c}") == 0).alias("passed")) for c in CRITICAL]
    items += [
        F.struct(F.lit("No duplicate order_ids").alias("check"), F.col("dupes").alias("violations"), (F.col("dupes") == 0).alias("passed")),
        F.struct(F.lit("All amounts > 0").alias("check"), F.col("non_positive").alias("violations"), (F.col("non_positive") == 0).alias("passed")),
        F.struct(F.lit("No future sale dates").alias("check"), F.col("future").alias("violations"), (F.col("future") == 0).alias("passed")),
        F.struct(F.lit("Valid category values").alias("check"), F.col("bad_category").alias("violations"), (F.col("bad_category") == 0).alias("passed")),
        F.struct(
            F.lit(f"Row count >= {params.min_rows:,}").alias("check"),
            F.greatest(F.lit(params.min_rows) - F.col("rows"), F.lit(0)).cast("long").alias("violations"),
            (F.col("rows") >= params.min_rows).alias("passed"),
        ),
    ]
    return wide.select(F.explode(F.array(*items)).alias("c")).select("c.*")


def score(check_rows: DataFrame) -> DataFrame:
    """V7: score = round(passed / total * 100, 1) and its band."""
    s = check_rows.agg(
        F.count_if("passed").alias("passed_checks"),
        F.count(F.lit(1)).alias("total_checks"),
    )
    s = s.withColumn("score", F.bround(F.col("passed_checks") / F.col("total_checks") * 100.0, 1))
    return s.withColumn("band", quality_band("score"))
