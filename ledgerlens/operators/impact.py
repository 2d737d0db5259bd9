"""Impact scores (I1-I6) for categories and regions.

The scored tables are one row per category/region; their min/max come from
one global aggregate joined back as a broadcast row. The expensive part is
the grouped aggregate underneath, an ordinary distributed group-by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.labels import grade
from ledgerlens.operators.common import delivered, facts, mean_of, non_null_key, sum_d, total


def normalize(c: str, mn: Column, mx: Column) -> Column:
    """Min-max scale to 0-100 rounded to 2; 50 everywhere when max = min."""
    scaled = F.bround(F.try_divide((F.col(c) - mn).cast("double"), (mx - mn).cast("double")) * 100.0, 2)
    return F.when(mx == mn, F.lit(50.0)).otherwise(scaled)


def with_scores(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add min-max scores ``{score_col: value_col}``; the min/max are one global aggregate.

    The one-row min/max table is broadcast (bounded by construction), so the
    scored table is never pulled into a single un-partitioned window.
    """
    stats = df.agg(*[F.min(v).alias(f"_mn_{v}") for v in spec.values()], *[F.max(v).alias(f"_mx_{v}") for v in spec.values()])
    out = df.crossJoin(F.broadcast(stats))
    out = out.withColumns({s: normalize(v, F.col(f"_mn_{v}"), F.col(f"_mx_{v}")) for s, v in spec.items()})
    return out.drop(*[c for c in out.columns if c.startswith("_mn_") or c.startswith("_mx_")])


def category_growth(clean: DataFrame) -> DataFrame:
    """Growth % per category from its last two present months; 0 with one month or prev = 0."""
    d = non_null_key(delivered(facts(clean)), "category", "year", "month")
    m = d.groupBy("category", "year", "month").agg(sum_d("total_amount").alias("rev"))
    w = Window.partitionBy("category").orderBy("year", "month")
    m = m.withColumn("prev", F.lag("rev").over(w))
    last = m.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct("rev", "prev"), F.struct("year", "month")).alias("l"),
    )
    g = F.when(
        (F.col("n") >= 2) & (F.col("l.prev") != 0),
        F.try_divide(F.col("l.rev") - F.col("l.prev"), F.col("l.prev")) * 100.0,
    ).otherwise(F.lit(0.0))
    return last.select("category", g.alias("growth_pct"))


def score_categories(clean: DataFrame) -> DataFrame:
    """Revenue, orders, growth lookup, normalised scores, weighted score and grade."""
    d = non_null_key(delivered(facts(clean)), "category")
    agg = d.groupBy("category").agg(sum_d("total_amount").alias("revenue"), total("n_orders").alias("orders"))
    # keyed lookup, missing = 0 (both sides are one row per category)
    agg = agg.join(category_growth(clean), "category", "left").withColumn("growth_pct", F.coalesce("growth_pct", F.lit(0.0)))
    agg = with_scores(agg, {"rev_score": "revenue", "growth_score": "growth_pct", "vol_score": "orders"})
    wr, wg, wv = S.CATEGORY_WEIGHTS
    score = F.col("rev_score") * wr + F.col("growth_score") * wg + F.col("vol_score") * wv
    agg = agg.withColumn("impact_score", F.bround(score, 1))
    return agg.withColumn("grade", grade("impact_score")).orderBy(F.col("impact_score").desc(), "category")


def score_regions(clean: DataFrame) -> DataFrame:
    """Region score = 0.60 revenue + 0.25 orders + 0.15 average value."""
    d = non_null_key(delivered(facts(clean)), "region")
    agg = d.groupBy("region").agg(
        sum_d("total_amount").alias("revenue"), total("n_orders").alias("orders"), mean_of("total_amount", "n_amounts").alias("avg_val")
    )
    agg = with_scores(agg, {"rev_score": "revenue", "vol_score": "orders", "val_score": "avg_val"})
    wr, wv, wa = S.REGION_WEIGHTS
    score = F.col("rev_score") * wr + F.col("vol_score") * wv + F.col("val_score") * wa
    return agg.withColumn("impact_score", F.bround(score, 1)).orderBy(F.col("impact_score").desc(), "region")
