"""Report datasets (R1-R13): the numbers behind the MIS workbook and the PDF reports.

Rendering (cells, PDF layout, prose) is out of scope; each dataset is a
small DataFrame assembled from the KPI, trend, customer and projection
operators, all of which aggregate in a distributed way first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import customers, kpis, trends
from ledgerlens.operators.common import delivered, facts, non_null_key, total

# Fixed coaching thresholds and savings factors.
DISCOUNT_HIGH, DISCOUNT_MEDIUM = 20, 10
CHURN_HIGH, CHURN_MEDIUM = 30, 15
RETURN_HIGH, RETURN_MEDIUM = 15, 10
CHURN_ALERT = 20
DISCOUNT_SAVING = 0.05
WINBACK_SHARE = 0.25
RETURN_SAVING = 0.03
MIS_DATA_COLUMNS = ("order_id", "product_name", "category", "total_amount", "region", "city", "sale_date", "order_status", "payment_method")


def _tops(clean: DataFrame) -> DataFrame:
    return kpis.top_keys(clean, {"category": "top_category", "region": "top_region"})


def mis_summary(clean: DataFrame) -> DataFrame:
    """Executive summary rows (metric, value, text_value, change_pct)."""
    h = kpis.headline(clean)
    g = kpis.mom_growth(clean).select("mom_growth_pct")
    one = h.crossJoin(g).crossJoin(_tops(clean))
    aov = F.coalesce(F.col("avg_order_value"), F.lit(0.0))
    rows = [
        ("Total Revenue", F.col("total_revenue"), None, F.col("mom_growth_pct")),
        ("Total Orders", F.col("total_orders").cast("double"), None, None),
        ("Avg Order Value", aov, None, None),
        ("Return Rate", F.col("return_rate_pct"), None, None),
        ("Top Category", None, F.col("top_category"), None),
        ("Top Region", None, F.col("top_region"), None),
    ]
    items = [
        F.struct(
            F.lit(i).alias("row_no"),
            F.lit(name).alias("metric"),
            (v if v is not None else F.lit(None)).cast("double").alias("value"),
            (t if t is not None else F.lit(None)).cast("string").alias("text_value"),
            (c if c is not None else F.lit(None)).cast("double").alias("change_pct"),
        )
        for i, (name, v, t, c) in enumerate(rows, start=1)
    ]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def mis_monthly(clean: DataFrame) -> DataFrame:
    """R2: year, month, month_name, revenue (2 decimals), orders."""
    return trends.monthly_trend(clean).select("year", "month", "month_name", "revenue", "orders")


def category_table(clean: DataFrame, share_digits: int) -> DataFrame:
    """Delivered revenue, orders and revenue share per category (one row per category)."""
    d = non_null_key(delivered(facts(clean)), "category")
    c = d.groupBy("category").agg(F.sum("total_amount").alias("rev_dec"), total("n_orders").alias("orders"))
    # exact decimal total (one row, broadcast), so the share is order-independent
    whole = c.agg(F.sum("rev_dec").alias("_total"))
    return c.crossJoin(F.broadcast(whole)).select(
        "category",
        F.col("rev_dec").cast("double").alias("revenue"),
        "orders",
        F.bround(F.try_divide(F.col("rev_dec").cast("double"), F.col("_total").cast("double")) * 100.0, share_digits).alias("share_pct"),
    )


def mis_categories(clean: DataFrame) -> DataFrame:
    """Category sheet with share % (2 decimals), by revenue descending."""
    return category_table(clean, 2).orderBy(F.col("revenue").desc(), "category")


def mis_data(clean: DataFrame, n: int = S.MIS_DATA_ROWS) -> DataFrame:
    """The first ``n`` delivered rows in arrival order (a top-k, never a full sort)."""
    d = delivered(clean)
    order = [c for c in ("loaded_at", "load_seq") if c in d.columns] + ["order_id"]
    return d.orderBy(*order).limit(n).select(*MIS_DATA_COLUMNS)


def impact_metrics(clean: DataFrame) -> DataFrame:
    """R5 + R7: unrounded revenue and AOV, return rate, MoM, tops and the good/bad flags."""
    h = kpis.headline(clean).select(F.col("total_rev").alias("total_revenue"), "total_orders", "return_rate_pct")
    g = kpis.mom_growth(clean).select("mom_growth_pct", F.col("this_month_raw").alias("this_month_rev"), F.col("last_month_raw").alias("last_month_rev"), "n_months")
    one = h.crossJoin(g).crossJoin(_tops(clean))
    aov = F.coalesce(F.try_divide(F.col("total_revenue"), F.col("total_orders").cast("double")), F.lit(0.0))
    return one.select(
        "total_revenue",
        "total_orders",
        aov.alias("avg_order_value"),
        "return_rate_pct",
        "mom_growth_pct",
        F.when(F.col("n_months") >= 2, F.col("this_month_rev")).alias("this_month_rev"),
        F.when(F.col("n_months") >= 2, F.col("last_month_rev")).alias("last_month_rev"),
        "top_category",
        "top_region",
        (F.col("mom_growth_pct") >= 0).alias("growth_good"),
        (F.col("return_rate_pct") < RETURN_HIGH).alias("return_rate_good"),
    )


def impact_categories(clean: DataFrame) -> DataFrame:
    """Category revenue with share % (1 decimal), by revenue descending."""
    return category_table(clean, 1).drop("orders").orderBy(F.col("revenue").desc(), "category")


def coach_metrics(clean: DataFrame) -> DataFrame:
    """Return rate, mean discount, revenue, total discount, discount % of revenue, growth."""
    # one pass for the totals (headline) and one for the monthly growth
    h = kpis.headline(clean)
    g = kpis.mom_growth(clean).select(F.col("mom_growth_raw").alias("growth"))
    one = h.crossJoin(g)
    return one.select(
        "return_rate_pct",
        "avg_discount_pct",
        "total_rev",
        "total_disc",
        F.bround(F.try_divide(F.col("total_disc"), F.col("total_rev")) * 100.0, 2).alias("disc_pct_rev"),
        "growth",
        "returned_orders",
        "all_orders",
        "mean_delivered_amount",
    )


def best_worst(clean: DataFrame) -> DataFrame:
    """Best and worst category and region by delivered revenue (ties: smallest key)."""
    return kpis.top_keys(
        clean,
        {"category": "top_category", "region": "top_region"},
        {"category": "low_category", "region": "low_region"},
    )


def weekend_revenue(clean: DataFrame) -> DataFrame:
    """Weekend vs weekday revenue (same as TR5)."""
    return trends.weekend_vs_weekday(clean)


def _priority(v, high, medium):
    return F.when(v > high, "HIGH").when(v > medium, "MEDIUM").otherwise("LOW")


def coach_cards(clean: DataFrame, churn_days: int = S.CHURN_DAYS, single: DataFrame | None = None) -> DataFrame:
    """R11 + R12: one row per coaching card: topic, subject, metric, priority, savings estimate.

    ``clean`` may be the roll-up; ``single`` then has the sales, for the customers.
    """
    m = coach_metrics(clean)
    ch = customers.report_churn(single if single is not None else clean, churn_days).select("churned_customers", "churn_rate_pct")
    bw = best_worst(clean).select("top_category", "low_category")
    one = m.crossJoin(ch).crossJoin(bw)
    mean_amt = F.coalesce(F.col("mean_delivered_amount"), F.lit(0.0))
    cards = [
        ("revenue", F.lit("MoM growth"), F.col("growth"), F.when(F.col("growth") < 0, "HIGH").otherwise("LOW"), F.lit(None)),
        ("discount", F.lit("Average discount"), F.col("avg_discount_pct"), _priority(F.col("avg_discount_pct"), DISCOUNT_HIGH, DISCOUNT_MEDIUM), F.col("total_disc") * DISCOUNT_SAVING),
        ("churn", F.lit("Customer churn rate"), F.col("churn_rate_pct"), _priority(F.col("churn_rate_pct"), CHURN_HIGH, CHURN_MEDIUM), F.col("churned_customers") * WINBACK_SHARE * mean_amt),
        ("category_top", F.col("top_category"), F.lit(None), F.lit("LOW"), F.lit(None)),
        ("category_low", F.col("low_category"), F.lit(None), F.lit("MEDIUM"), F.lit(None)),
        ("returns", F.lit("Return rate"), F.col("return_rate_pct"), _priority(F.col("return_rate_pct"), RETURN_HIGH, RETURN_MEDIUM), F.col("returned_orders") * RETURN_SAVING * mean_amt),
    ]
    items = [
        F.struct(
            F.lit(i).alias("card_no"),
            F.lit(topic).alias("topic"),
            subj.cast("string").alias("subject"),
            metric.cast("double").alias("metric"),
            prio.alias("priority"),
            save.cast("double").alias("savings_estimate"),
        )
        for i, (topic, subj, metric, prio, save) in enumerate(cards, start=1)
    ]
    return one.select(F.explode(F.array(*items)).alias("c")).select("c.*")


def churn_alert(clean: DataFrame, churn_days: int = S.CHURN_DAYS) -> DataFrame:
    """Report churn with the alert flag (rate > 20)."""
    r = customers.report_churn(clean, churn_days)
    return r.withColumn("churn_alert", F.col("churn_rate_pct") > CHURN_ALERT)


__all__ = [
    "best_worst",
    "churn_alert",
    "coach_cards",
    "coach_metrics",
    "impact_categories",
    "impact_metrics",
    "mis_categories",
    "mis_data",
    "mis_monthly",
    "mis_summary",
    "weekend_revenue",
]

