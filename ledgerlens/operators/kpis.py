"""KPI engine.

All scalar KPIs come from a handful of aggregates over the cleaned table or
its roll-up (``operators/rollup.py``): one conditional aggregate (K1, K2, K4,
K7, K9), the monthly table (K5/K6/K11) and the top keys (K8). Distinct
customers (K3) and top products need the sales themselves. Each is a
distributed aggregate with map-side partial aggregation; the results are
one-row frames joined as broadcast scalars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.common import delivered, facts, mean_of, monthly_revenue, non_null_key, sum_d, total


def headline(clean: DataFrame) -> DataFrame:
    """K1, K2, K4, K7, K9 in one pass over sales or their roll-up: revenue, orders, AOV, return rate, discounts."""
    sales = facts(clean)
    is_d = F.col("order_status") == S.STATUS_DELIVERED
    agg = sales.agg(
        F.sum(F.when(is_d, F.col("total_amount"))).cast("double").alias("_rev"),
        total("n_rows", is_d).alias("total_orders"),
        total("n_rows", F.col("order_status") == S.STATUS_RETURNED).alias("returned_orders"),
        total("n_rows").alias("all_orders"),
        mean_of("discount_pct", "n_discounts").alias("_disc_mean"),
        F.sum("discount_amt").cast("double").alias("_disc_sum"),
        total("n_amounts", is_d).alias("_d_amounts"),
    )
    return agg.select(
        F.bround(F.coalesce(F.col("_rev"), F.lit(0.0)), 2).alias("total_revenue"),
        "total_orders",
        F.bround(F.try_divide(F.bround(F.coalesce(F.col("_rev"), F.lit(0.0)), 2), F.col("total_orders").cast("double")), 2).alias("avg_order_value"),
        F.bround(F.try_divide(F.col("returned_orders").cast("double"), F.col("all_orders").cast("double")) * 100.0, 2).alias("return_rate_pct"),
        "returned_orders",
        "all_orders",
        F.bround("_disc_mean", 2).alias("avg_discount_pct"),
        F.bround("_disc_sum", 2).alias("total_discount"),
        # unrounded values the report datasets use
        F.coalesce(F.col("_rev"), F.lit(0.0)).alias("total_rev"),
        F.col("_disc_sum").alias("total_disc"),
        F.try_divide(F.col("_rev"), F.col("_d_amounts").cast("double")).alias("mean_delivered_amount"),
    )


HEADLINE_KPIS = (
    "total_revenue", "total_orders", "total_customers", "avg_order_value", "return_rate_pct", "avg_discount_pct", "total_discount",
)


def customers(clean: DataFrame) -> DataFrame:
    """K3: distinct e-mails of all rows, which no roll-up adds up to (``rollup.approx_customers`` is the mergeable form)."""
    return clean.agg(F.count_distinct("customer_email").alias("total_customers"))


def monthly(clean: DataFrame) -> DataFrame:
    """Delivered revenue by (year, month)."""
    return monthly_revenue(clean).select("year", "month", F.bround("revenue", 2).alias("revenue"))


def mom_growth(clean: DataFrame) -> DataFrame:
    """K6: growth % between the last two monthly rows; 0 (others NULL) with fewer than two months.

    The monthly table has one row per month present; ``max_by`` over it picks
    the last month without a sort.
    """
    m = monthly_revenue(clean)
    w = Window.orderBy("year", "month")  # months only: a tiny table
    m = m.withColumn("prev", F.lag("revenue").over(w))
    last = m.agg(
        F.count(F.lit(1)).alias("n_months"),
        F.max_by(F.struct("revenue", "prev"), F.struct("year", "month")).alias("l"),
    )
    growth = F.try_divide(F.col("l.revenue") - F.col("l.prev"), F.col("l.prev")) * 100.0
    two = F.col("n_months") >= 2
    return last.select(
        F.when(two, F.bround(growth, 2)).otherwise(F.lit(0.0)).alias("mom_growth_pct"),
        F.when(two, F.bround("l.revenue", 2)).alias("this_month_rev"),
        F.when(two, F.bround("l.prev", 2)).alias("last_month_rev"),
        F.when(two, growth).otherwise(F.lit(0.0)).alias("mom_growth_raw"),
        F.col("l.revenue").alias("this_month_raw"),
        F.col("l.prev").alias("last_month_raw"),
        "n_months",
    )


def revenue_by(clean: DataFrame, key: str) -> DataFrame:
    """Delivered revenue and orders per ``key`` (NULL keys dropped, as pandas does)."""
    d = non_null_key(delivered(facts(clean)), key)
    return d.groupBy(key).agg(sum_d("total_amount").alias("revenue"), total("n_orders").alias("orders"))


def top_keys(clean: DataFrame, keys: dict[str, str], bottom: dict[str, str] | None = None) -> DataFrame:
    """Largest (and smallest) delivered-revenue key per dimension, in one scan.

    One ``GROUPING SETS`` aggregate gives the revenue per value of every
    dimension (NULL keys dropped), and a single global aggregate picks the
    top/bottom key of each set with ``min_by`` (ties: smallest key).
    ``keys``/``bottom`` map a dimension column to its output name.
    """
    bottom = bottom or {}
    dims = list(dict.fromkeys([*keys, *bottom]))
    d = delivered(facts(clean))
    g = d.groupingSets([[k] for k in dims], *dims).agg(
        *[F.grouping(k).alias(f"_g_{k}") for k in dims], sum_d("total_amount").alias("_rev")
    )
    aggs = []
    for k in dims:
        in_set = (F.col(f"_g_{k}") == 0) & F.col(k).isNotNull()
        if k in keys:
            aggs.append(F.min_by(F.when(in_set, F.col(k)), F.when(in_set, F.struct((-F.col("_rev")).alias("v"), F.col(k).alias("k")))).alias(keys[k]))
        if k in bottom:
            aggs.append(F.min_by(F.when(in_set, F.col(k)), F.when(in_set, F.struct(F.col("_rev").alias("v"), F.col(k).alias("k")))).alias(bottom[k]))
    return g.agg(*aggs)


def top_performers(clean: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """K8: top category, region and product by delivered revenue (ties: smallest key).

    A roll-up has no products: they come from the sales, ``products``.
    """
    if products is None:
        return top_keys(clean, {"category": "top_category", "region": "top_region", "product_name": "top_product"})
    return top_keys(clean, {"category": "top_category", "region": "top_region"}).crossJoin(top_keys(products, {"product_name": "top_product"}))


def category_revenue(clean: DataFrame) -> DataFrame:
    """Delivered revenue per category, descending (a sort of one row per category)."""
    c = revenue_by(clean, "category")
    return c.orderBy(F.col("revenue").desc(), "category").select("category", F.bround("revenue", 2).alias("revenue"))


def kpi_summary(clean: DataFrame, single: DataFrame | None = None) -> DataFrame:
    """The KPI record as one row (persisted to ``kpi_summary`` by the batch job).

    ``clean`` may be the roll-up; ``single`` then has the sales, for customers and products.
    """
    h = headline(clean).crossJoin(customers(single if single is not None else clean)).select(*HEADLINE_KPIS)
    g = mom_growth(clean).select("mom_growth_pct", "this_month_rev", "last_month_rev")
    return h.crossJoin(g).crossJoin(top_performers(clean, single))
