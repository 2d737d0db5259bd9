"""Customer features and report-style churn.

One scan builds every per-customer feature: sales are first summed by
(customer, category, region) with hash aggregates, and the favourites are
picked from these sums. The fill e-mail from C3 can hold a large share of all
rows (one hot key); the sums are partial-aggregated map-side, so the hot key
ships at most one row per category and region and map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.common import delivered, mean_d, non_null_key, sum_d


def reference_date(clean: DataFrame) -> DataFrame:
    """H3's "today": the latest sale_date over all rows (one row)."""
    return clean.agg(F.max("sale_date").alias("ref_date"))


def customer_features(clean: DataFrame, churn_days: int = S.CHURN_DAYS) -> DataFrame:
    """H1-H6: per-customer aggregates over delivered sales, favourites, recency and the churn label."""
    d = non_null_key(delivered(clean), "customer_email")
    cells = d.groupBy("customer_email", "category", "region").agg(
        F.count(F.lit(1)).alias("sales"),
        F.count("order_id").alias("orders"),
        F.sum("total_amount").alias("spent"),
        F.count("total_amount").alias("amounts"),
        F.max("sale_date").alias("last"),
        F.min("sale_date").alias("first"),
        F.sum("discount_pct").alias("discount"),
        F.count("discount_pct").alias("discounts"),
    )
    # a customer has one row per category and region at most; windows and aggregate share one exchange
    cells = cells.repartition("customer_email").withColumns(
        {f"{c}_sales": F.sum("sales").over(Window.partitionBy("customer_email", c)) for c in ("category", "region")}
    )

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))

    def favourite(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(-F.col(f"{c}_sales"), F.col(c))))

    agg = cells.groupBy("customer_email").agg(
        F.sum("orders").alias("total_orders"),
        sum_d("spent").alias("total_spent"),
        mean("spent", "amounts").alias("avg_order_value"),
        F.max("last").alias("last_order_date"),
        F.min("first").alias("first_order_date"),
        favourite("category").alias("fav_category"),
        favourite("region").alias("fav_region"),
        mean("discount", "discounts").alias("avg_discount"),
    )
    ref = reference_date(clean)
    # one-row scalar: broadcast is bounded by construction
    out = agg.crossJoin(F.broadcast(ref))
    out = out.withColumns(
        {
            "days_since_last": F.date_diff("ref_date", "last_order_date"),
            "customer_lifetime": F.date_diff("last_order_date", "first_order_date"),
        }
    )
    out = out.withColumn(
        "order_frequency", F.bround(F.col("total_orders") / (F.col("customer_lifetime") / 30.0 + 1.0), 3)
    )
    out = out.withColumn("churned", (F.col("days_since_last") >= churn_days).cast("int"))
    return out.drop("ref_date")


def churn_summary(features: DataFrame) -> DataFrame:
    """H6: customers, churned count and churn rate (% with one decimal)."""
    return features.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("churned").alias("churned"),
        F.bround(F.avg("churned") * 100.0, 1).alias("churn_rate_pct"),
    )


def report_churn(clean: DataFrame, churn_days: int = S.CHURN_DAYS) -> DataFrame:
    """H15 + H16: customers whose last delivered order is before (latest date - 90 days).

    Returns total customers, churned, rate (1 decimal, 0 when no customers),
    mean delivered amount and the revenue at risk (churned x mean amount).
    """
    d = non_null_key(delivered(clean), "customer_email")
    last = d.groupBy("customer_email").agg(F.max("sale_date").alias("last_date"))
    ref = reference_date(clean)
    cutoff = F.date_sub(F.col("ref_date"), churn_days)
    counted = last.crossJoin(F.broadcast(ref)).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("last_date") < cutoff).alias("churned_customers"),
    )
    mean_amt = delivered(clean).agg(mean_d("total_amount").alias("mean_delivered_amount"))
    out = counted.crossJoin(mean_amt)
    rate = F.bround(F.try_divide(F.col("churned_customers").cast("double"), F.col("total_customers").cast("double")) * 100.0, 1)
    return out.select(
        "total_customers",
        "churned_customers",
        F.coalesce(rate, F.lit(0.0)).alias("churn_rate_pct"),
        F.coalesce(F.col("mean_delivered_amount"), F.lit(0.0)).alias("mean_delivered_amount"),
        (F.col("churned_customers") * F.coalesce(F.col("mean_delivered_amount"), F.lit(0.0))).alias("revenue_at_risk"),
    )
