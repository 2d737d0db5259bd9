"""Column helpers: text (T3/T4), calendar (T15/T16), bands (T10), ties (T12), labels."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import calendar_columns, revenue_band, standardise, strip_ws, title_case
from ledgerlens.functions.labels import grade, quality_band, risk_level


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_title_case_restarts_after_non_letters(spark):
    cases = {
        "t-SHIRT": "T-Shirt",
        "rice 5kg": "Rice 5Kg",
        "MIDDLE EAST": "Middle East",
        "1-URGENT": "1-Urgent",
        "NATION_12": "Nation_12",
        "o'neil": "O'Neil",
        "": "",
    }
    for raw, want in cases.items():
        assert _one(spark, title_case(F.col("v")), raw) == want == raw.title()


def test_title_case_null(spark):
    assert _one(spark, title_case(F.col("v")), None) is None


def test_title_case_forms_agree_with_python(spark):
    from ledgerlens.functions.text import title_case_runs

    words = ["a\tb", "x  y", "ÉCOLE über", "3rd-party's item", "--a--b", "snake_case_x", "ALL CAPS 2024", "é-à"]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    for r in df.select("v", title_case("v").alias("a"), title_case_runs("v").alias("b")).collect():
        assert r.a == r.b == r.v.title()


def test_strip_removes_all_whitespace_kinds(spark):
    assert _one(spark, strip_ws(F.col("v")), " \t Fashion \n") == "Fashion"
    assert _one(spark, standardise(F.col("v")), "\t electronics  ") == "Electronics"


def test_calendar_monday_zero_and_full_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),), (dt.date(2024, 3, 11),)], "d date")
    cols = calendar_columns("d")
    rows = df.select(*[c.alias(k) for k, c in cols.items()]).orderBy("day_of_week").collect()
    sat = [r for r in rows if r.day_of_week == "Saturday"][0]
    mon = [r for r in rows if r.day_of_week == "Monday"][0]
    assert sat.is_weekend and not mon.is_weekend
    assert sat.month_name == "March" and sat.quarter == 1 and sat.year == 2024


def test_revenue_band_edges(spark):
    vals = [(None,), (-5.0,), (0.0,), (0.01,), (1000.0,), (1000.01,), (5000.0,), (20000.0,), (20000.01,)]
    df = spark.createDataFrame(vals, "a double")
    got = [r.b for r in df.select(revenue_band("a").alias("b")).collect()]
    assert got == ["nan", "nan", "nan", "Low", "Low", "Medium", "Medium", "High", "Premium"]


def test_threshold_labels(spark):
    df = spark.createDataFrame([(x,) for x in (100.0, 75.0, 74.9, 50.0, 25.0, 0.0)], "s double")
    out = df.select(grade("s").alias("g"), risk_level("s").alias("r"), quality_band("s").alias("q")).collect()
    assert [o.g for o in out] == ["A", "A", "B", "B", "C", "D"]
    assert [o.r for o in out] == ["High", "High", "High", "Medium", "Low", "Low"]
    assert [o.q for o in out] == ["EXCELLENT", "ACCEPTABLE", "POOR", "POOR", "POOR", "POOR"]


def test_standardise_of_plain_text_equals_the_general_form(spark):
    words = ["MIDDLE EAST", "  two   words ", "a", "", "   ", None, "ECONOMY", "t-SHIRT", "x y Z", "\ta b", "ÉCOLE", "NATION_7"]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    got = df.select(standardise("v").alias("a"), title_case(strip_ws("v")).alias("b"))
    assert "trim" in got._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.a == r.b for r in got.collect())
