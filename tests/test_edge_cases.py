"""Ingest, cleaning and models on input that the supplied tables do not have."""

import datetime as dt
import os

import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.__main__ import main
from ledgerlens.functions.text import standardise
from ledgerlens.operators import churn_model, cleaning, forecast
from ledgerlens.operators.quantile import iqr_fences
from ledgerlens.sources import files, fixture
from ledgerlens.streaming import ingest

NAMES = [f.name for f in S.RAW_CSV.fields]
VALUES = "{id},n,e,p,prod,Fashion,10.00,{q},0,0,{amt},UPI,North,Delhi,2024-01-02,Delivered,s"


def drop(path, rows, names=NAMES, mtime=None):
    lines = [",".join(names)]
    for r in rows:
        cells = dict(zip(NAMES, VALUES.format(**({"q": "1", "amt": "5.00"} | r)).split(",")))
        lines.append(",".join(cells[n] for n in names))
    path.write_text("\n".join(lines) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    drop(tmp_path / "a.csv", [{"id": "A"}], names=list(reversed(NAMES)))
    row = files.coerce_raw(files.read_raw_csv(spark, str(tmp_path))).first()
    assert row["order_id"] == "A" and row["region"] == "North" and row["city"] == "Delhi"


def test_missing_csv_column_fails(spark, tmp_path):
    drop(tmp_path / "a.csv", [{"id": "A"}], names=[n for n in NAMES if n != "city"])
    with pytest.raises(files.MissingInput, match="city"):
        files.read_raw_csv(spark, str(tmp_path))


def test_older_file_comes_first_whatever_its_size(spark, tmp_path):
    drop(tmp_path / "z_old.csv", [{"id": "A", "amt": "1.00"}], mtime=1_000_000)
    drop(tmp_path / "a_new.csv", [{"id": f"B{i}"} for i in range(3000)] + [{"id": "A", "amt": "2.00"}], mtime=2_000_000)
    rows = files.coerce_raw(files.read_raw_csv(spark, str(tmp_path)))
    seq = {(r["order_id"], str(r["total_amount"])): r["load_seq"] for r in rows.where("order_id = 'A'").collect()}
    assert seq["A", "1.00"] < seq["A", "2.00"]
    assert rows.select("load_seq").distinct().count() == 3002


@pytest.mark.parametrize(("text", "value"), [("2.0", 2), ("3", 3), ("2.5", None), ("x", None)])
def test_quantities(spark, tmp_path, text, value):
    drop(tmp_path / "a.csv", [{"id": "A", "q": text}])
    assert files.coerce_raw(files.read_raw_csv(spark, str(tmp_path))).first()["quantity"] == value


def test_white_space_of_any_script_is_stripped(spark):
    df = spark.createDataFrame([(" home　",), ("\x1c home\n",)], "c string")
    assert [r[0] for r in df.select(standardise("c")).collect()] == ["Home", "Home"]


def test_null_arrival_sorts_last(spark):
    raw = fixture.raw_sales(spark, SF_SMALL).limit(1).drop("loaded_at", "load_seq", "total_amount")
    when = spark.createDataFrame([(None, 1, 1), (dt.datetime(2024, 1, 1), 2, 2)], "loaded_at timestamp_ntz, load_seq long, amt int")
    rows = raw.crossJoin(when).withColumn("total_amount", F.col("amt").cast(S.MONEY))
    first = cleaning.mark_first_arrival(rows, fixture.fixture_params()).where("_first").collect()
    assert [int(r["total_amount"]) for r in first] == [2]


def test_ties_of_a_feeds_own_arrival_keep_one_row(spark, tmp_path):
    one = fixture.raw_sales(spark, SF_SMALL).limit(1).drop("load_seq")
    rows = one.crossJoin(spark.createDataFrame([(2**63 - 1,), (5,), (5,), (5,), (None,)], "load_seq long"))
    files.write_raw(rows.repartition(3), str(tmp_path / "raw"))
    raw = files.read_raw(spark, str(tmp_path / "raw"))
    assert raw.select("row_id").distinct().count() == 5
    first = cleaning.mark_first_arrival(raw, S.Params()).where("_first").collect()
    assert [r["load_seq"] for r in first] == [5]


def test_nothing_left_to_clean(spark, tmp_path):
    none = fixture.raw_sales(spark, SF_SMALL).withColumn("total_amount", F.lit(None).cast(S.MONEY))
    none = none.withColumn("row_id", F.monotonically_increasing_id())
    assert cleaning.write_reasons(none, fixture.fixture_params(), str(tmp_path / "reasons")).where("drop_reason is null").count() == 0


def test_fences_of_nothing_are_null(spark):
    row = iqr_fences(spark.createDataFrame([], "x double"), "x").first()
    assert row["lower"] is None and row["upper"] is None


@pytest.mark.parametrize("n", [1, 2, 13, 14, 400])
def test_one_forecast_for_any_length(n):
    days = pd.date_range("2024-01-01", periods=n)
    out = forecast.fit_predict(pd.DataFrame({"series": "ALL", "ds": days.date, "y": [100.0 + i for i in range(n)]}), 5)
    assert len(out) == 5 and out.yhat.notna().all() and (out.yhat_lower <= out.yhat_upper).all()
    assert out.yhat.between(0, 1200).all()


def test_stream_batches_do_not_overlap():
    # 200 splits in a batch use task numbers 0..199
    highest = (199 << files.POSITION_BITS) + 5
    assert ingest.first_seq(None) == 0
    assert ingest.first_seq(highest) == 200 << files.POSITION_BITS > highest


def test_many_categories_fit(spark):
    rows = [(f"c{i}@x", float(i), i % 7, float(i % 50), f"cat{i % 40}", f"r{i % 3}", i % 2) for i in range(400)]
    names = "customer_email string, a double, b int, c double, fav_category string, fav_region string, churned int"
    df = spark.createDataFrame(rows, names).withColumn("label", F.col("churned").cast("double")).withColumn("w", F.lit(1.0))
    model = churn_model.build_model(("a", "b", "c", "fav_category_enc", "fav_region_enc"), num_trees=3, max_depth=3).fit(df)
    assert model.transform(df).count() == 400


def test_exit_codes(spark, tmp_path):
    drop(tmp_path / "feed.csv", [{"id": f"O{i}", "amt": f"{10 + i}.00"} for i in range(60)])
    out = str(tmp_path / "out")
    common = ["--tables", SF_SMALL, "--out", out, "--master", "local[*]"]
    assert main(["batch", "--csv", str(tmp_path / "feed.csv"), "--as-of", "2024-06-30", *common]) == 0
    assert spark.read.parquet(f"{out}/cleaned_sales").count() == 60
    assert spark.read.parquet(f"{out}/kpi_monthly_revenue").count() == 1
    assert main(["batch", "--csv", str(tmp_path / "missing.csv"), *common]) == 1
