"""Replacement of tables, the roll-up, sketches, and rank-sum AUC."""

import random

import numpy as np
import pytest
from conftest import SF_SMALL
from oracle_harness import _norm
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens.operators import churn_model, forecast, impact, kpis, projection, reports, rollup, trends
from ledgerlens.operators.quantile import merged_sketch, quartiles
from ledgerlens.plans import catalog
from ledgerlens.session import scratch_path
from ledgerlens.sources import files


def fresh(spark, name):
    return scratch_path(spark, f"{name}_{random.random()}")


# --- replacement


def failing(spark, n):
    """Rows whose write fails in one task after others have written theirs."""
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_failed_write_leaves_the_old_rows(spark):
    path = fresh(spark, "replace")
    assert files.write_table(spark.range(10), path) == 10
    with pytest.raises(PySparkException):
        files.write_table(failing(spark, 100), path)
    assert files.read_table(spark, path).count() == 10
    assert files.write_table(spark.range(20), path) == 20
    assert files.read_table(spark, path).count() == 20


def test_unverified_rows_are_not_read(spark, monkeypatch):
    path = fresh(spark, "replace")
    files.write_table(spark.range(10), path)
    reader = type(spark.read)
    real = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *p, **kw: real(self, *p, **kw).limit(3) if "version-00000001" in str(p) else real(self, *p, **kw))
    with pytest.raises(files.UnverifiedWrite, match="5 rows written, 3 read back"):
        files.write_table(spark.range(5), path)
    monkeypatch.undo()
    assert files.read_table(spark, path).count() == 10


def test_the_version_before_stays_for_its_readers(spark):
    path = fresh(spark, "replace")
    files.write_table(spark.range(1), path)
    reading = files.read_table(spark, path)
    for n in (2, 3, 4):
        files.write_table(spark.range(n), path)
        if n == 2:
            assert reading.count() == 1
    assert [spark.read.parquet(v).count() for v in files.versions(spark, path)] == [3, 4]
    files.write_table(spark.range(0), path)
    assert files.read_table(spark, path).count() == 0


def test_a_plain_read_never_mixes_versions(spark):
    path = fresh(spark, "replace")
    files.write_table(spark.range(6).withColumn("year", F.col("id") % 2), path, partition_by=("year",))
    assert sorted(r["id"] for r in spark.read.parquet(path).select("id").collect()) == list(range(6))
    assert sorted(files.read_table(spark, path).columns) == ["id", "year"]
    for n in range(1, 12):  # the order of versions is that of their numbers
        files.write_table(spark.range(n).withColumn("year", F.col("id") % 2), path, partition_by=("year",))
        assert files.read_table(spark, path).count() == n and len(files.versions(spark, path)) == 2
    with pytest.raises(Exception, match="CONFLICTING_PARTITION_COLUMN_NAMES"):
        spark.read.parquet(path).count()


def test_a_first_write_that_fails_is_not_read(spark):
    path = fresh(spark, "replace")
    with pytest.raises(PySparkException):
        files.write_table(failing(spark, 100), path)
    with pytest.raises(files.UnverifiedWrite, match="no verified version"):
        files.read_table(spark, path)


def test_versions_of_earlier_tables_are_read_and_replaced(spark):
    path = fresh(spark, "replace")
    old = f"{path}/version-00000006-0a1b2c3d"
    spark.range(3).write.parquet(old)
    spark.createDataFrame([("",)], "value string").coalesce(1).write.text(f"{old}/_VERIFIED")
    assert files.read_table(spark, path).count() == 3
    files.write_table(spark.range(4), path)
    assert files.read_table(spark, path).count() == 4 and [spark.read.parquet(v).count() for v in files.versions(spark, path)] == [3, 4]
    files.write_table(spark.range(5), path)
    assert [spark.read.parquet(v).count() for v in files.versions(spark, path)] == [4, 5]


# --- roll-up


def rows(df):
    return sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)


MARTS = [
    kpis.headline, kpis.monthly, kpis.mom_growth, kpis.category_revenue, trends.monthly_trend, trends.category_trend, trends.region_trend,
    trends.weekend_vs_weekday, trends.category_share, trends.last_months, impact.score_categories, impact.score_regions, impact.category_growth,
    projection.daily_revenue, projection.revenue_projection, projection.category_projection, reports.mis_summary, reports.mis_monthly,
    reports.mis_categories, reports.impact_metrics, reports.impact_categories, reports.coach_metrics, reports.best_worst, reports.weekend_revenue,
]


def test_marts_of_the_roll_up_equal_those_of_the_sales(spark):
    # with NULL categories and regions; the registered queries hold the other feed's marts against SQL
    c = catalog.clean(spark, SF_SMALL, dirty=True)
    path = fresh(spark, "rollup")
    rollup.write(c, path)
    r = files.read_table(spark, path)
    assert r.count() < c.count()
    for mart in MARTS:
        assert rows(mart(r)) == rows(mart(c)), mart.__name__
    assert rows(kpis.kpi_summary(r, c)) == rows(kpis.kpi_summary(c))
    assert rows(reports.coach_cards(r, single=c)) == rows(reports.coach_cards(c))
    assert rows(forecast.forecast(r, 5)) == rows(forecast.forecast(c, 5))


def test_marts_of_no_sales_are_the_same(spark):
    c = catalog.clean(spark, SF_SMALL).limit(0)
    for mart in (kpis.headline, kpis.mom_growth, reports.mis_summary, projection.revenue_projection):
        assert rows(mart(rollup.sales_rollup(c))) == rows(mart(c))


def test_additive_marts_do_not_read_the_sales(spark):
    path = fresh(spark, "rollup")
    rollup.write(catalog.clean(spark, SF_SMALL), path)
    r = files.read_table(spark, path)
    for mart in MARTS:
        plan = mart(r)._jdf.queryExecution().optimizedPlan().toString() + str(mart(r).inputFiles())
        assert "cleaned_sales" not in plan


def test_refresh_replaces_some_months_only(spark):
    c = catalog.clean(spark, SF_SMALL)
    path = fresh(spark, "rollup")
    rollup.write(c, path)
    changed = c.where("not (year = 1997 and month = 3)").withColumn("total_amount", F.when(F.expr("year = 1997 and month = 4"), F.lit(1)).otherwise(F.col("total_amount")).cast("decimal(12,2)"))
    before = {f for f in files.read_table(spark, path).inputFiles()}
    rollup.refresh(changed, path, [(1997, 3), (1997, 4)])
    r = files.read_table(spark, path)
    assert rows(trends.monthly_trend(r)) == rows(trends.monthly_trend(changed)) and rows(kpis.headline(r)) == rows(kpis.headline(changed))
    gone = before - set(r.inputFiles())
    assert gone and all("year=1997" in f and ("month=3/" in f or "month=4/" in f) for f in gone)


# --- sketches


def test_sketches_of_months_merge_to_all_customers(spark):
    rng = random.Random(1)
    sales = spark.createDataFrame([(2024, rng.randint(1, 6), f"c{rng.randint(0, 30_000)}@x") for _ in range(60_000)] + [(2024, 1, None)], "year int, month int, customer_email string")
    exact = kpis.customers(sales).first()[0]
    sketches = rollup.customer_sketches(sales)
    assert sketches.count() == 6
    assert abs(rollup.approx_customers(sketches).first()[0] - exact) <= 0.03 * exact
    assert rollup.approx_customers(sketches.limit(0)).first()[0] == 0


@pytest.mark.parametrize("kind", ["even", "skewed", "hot value", "sorted"])
def test_approximate_quartiles_are_near_in_rank(spark, kind):
    rng = np.random.default_rng(2)
    x = {"even": rng.random(200_000), "skewed": rng.lognormal(0, 4, 200_000), "hot value": np.where(rng.random(200_000) < 0.4, 7.0, rng.random(200_000) * 20), "sorted": np.arange(200_000.0)}[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(50)
    got = quartiles(df, "x", "approx").first()
    for value, p in ((got.q1, 0.25), (got.q3, 0.75)):
        assert (x < value).mean() <= p + 0.003 and (x <= value).mean() >= p - 0.003


def test_quantile_sketches_are_merged_in_a_tree(spark):
    df = spark.range(0, 10_000, 1, 300).select(F.col("id").cast("double").alias("x"))
    plan = merged_sketch(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("Exchange SinglePartition") == 1
    assert quartiles(df.limit(0), "x", "approx").first().asDict() == {"q1": None, "q3": None}


# --- AUC


def brute_auc(scored):
    pos, neg = ([s for s, y in scored if y == k] for k in (1.0, 0.0))
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 3, 12])
def test_auc_is_the_share_of_ordered_pairs(spark, digits):
    rng = random.Random(digits)
    scored = [(round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), digits), float(y)) for y in (0, 1) for _ in range(150)] + [(1.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([*scored, (None, 1.0), (0.3, None)], "score double, label double")
    assert abs(churn_model.rank_auc(df).first()["auc"] - brute_auc(scored)) < 1e-12


def test_auc_of_one_class_is_null(spark):
    assert churn_model.rank_auc(spark.createDataFrame([(0.5, 1.0)], "score double, label double")).first()["auc"] is None
