"""Cleaning stage semantics on hand-made feeds (T2, T5, T6, T7, T8, T18) and report invariants."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import cleaning, quality
from ledgerlens.operators.quantile import exact_quantiles, iqr_fences
from ledgerlens.sources import files

P = S.Params(as_of=dt.date(2025, 3, 31))


def feed(spark, rows):
    """rows: (load_seq, order_id, total_amount, sale_date, category) with defaults for the rest."""
    full = []
    for seq, oid, amt, d, cat in rows:
        full.append((seq, oid, "n", None, None, "p", cat, None, 1, None, None,
                     None if amt is None else __import__("decimal").Decimal(str(amt)),
                     None, "north", "delhi", d, "delivered", "s", None))
    return spark.createDataFrame(full, S.RAW_SALES)


D = dt.date(2024, 5, 1)


def test_dedup_keeps_first_arrival_and_runs_before_null_drop(spark):
    raw = feed(spark, [
        (2, "A", 10.0, D, "fashion"),
        (1, "A", None, D, "fashion"),   # first copy has no amount: the order disappears (T6)
        (3, "B", 20.0, D, "fashion"),
        (4, "B", 30.0, D, "fashion"),
        (5, None, 40.0, D, "fashion"),  # NULL ids are one group (T5)
        (6, None, 50.0, D, "fashion"),
    ])
    t = {(r.order_id, r.load_seq): r.drop_reason for r in cleaning.tag_pre_fence(raw, P).collect()}
    assert t[("A", 1)] == "null_critical" and t[("A", 2)] == "duplicate"
    assert t[("B", 3)] is None and t[("B", 4)] == "duplicate"
    assert t[(None, 5)] == "null_critical" and t[(None, 6)] == "duplicate"


def test_date_window_and_amount_rules(spark):
    raw = feed(spark, [
        (1, "A", 10.0, dt.date(2022, 12, 31), "x"),
        (2, "B", 10.0, dt.date(2023, 1, 1), "x"),
        (3, "C", 10.0, dt.date(2025, 3, 31), "x"),
        (4, "D", 10.0, dt.date(2099, 1, 1), "x"),
        (5, "E", 0.0, D, "x"),
        (6, "F", -999.0, D, "x"),
    ])
    t = {r.order_id: r.drop_reason for r in cleaning.tag_pre_fence(raw, P).collect()}
    assert t == {"A": "invalid_date", "B": None, "C": None, "D": "invalid_date", "E": "non_positive", "F": "non_positive"}


def test_report_accounts_for_every_row(spark):
    rows = [(i, f"O{i % 40}", float(10 + i % 17), D, "fashion") for i in range(100)]
    rows.append((1000, "BIG", 1e7, D, "fashion"))
    raw = feed(spark, rows)
    tagged = cleaning.tag(raw, P)
    rep = cleaning.cleaning_report(tagged).first().asDict()
    removed = sum(rep[k] for k in cleaning.REPORT_KEYS.values())
    assert rep["original_rows"] == rep["final_rows"] + removed == 101
    assert rep["outliers_removed"] == 1 and rep["duplicates_removed"] == 60
    assert cleaning.clean(raw, P).count() == rep["final_rows"]


def test_fill_defaults_and_text(spark):
    raw = feed(spark, [(1, "A", 10.0, D, " t-SHIRT ")])
    r = cleaning.clean(raw, P).first()
    assert r.customer_email == S.FILL_EMAIL and r.payment_method == "Unknown"
    assert float(r.discount_pct) == 0.0 and r.category == "T-Shirt" and r.region == "North"
    assert r.revenue_band == "Low" and r.order_status == "Delivered"


def test_category_check_counts_nulls_as_invalid(spark):
    raw = feed(spark, [(1, "A", 10.0, D, "Fashion"), (2, "B", 10.0, D, None), (3, "C", 10.0, D, "toys")])
    chk = {r.check: r.violations for r in quality.checks(raw, P).collect()}
    assert chk["Valid category values"] == 2
    assert chk["No nulls in 'category'"] == 1


def test_coercion_turns_bad_values_into_nulls(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    hdr = ",".join(f.name for f in S.RAW_CSV.fields)
    good = "ORD1,n,e,p,prod,Fashion,10.5,2,5,1.05,19.95,UPI,North,Delhi,2024-01-02,Delivered,s"
    bad = "ORD2,n,e,p,prod,Fashion,abc,x,5,1.05,oops,UPI,North,Delhi,not-a-date,Delivered,s"
    open(path, "w").write("\n".join([hdr, good, bad]) + "\n")
    df = files.coerce_raw(files.read_raw_csv(spark, path)).orderBy("order_id").collect()
    assert float(df[0].total_amount) == 19.95 and df[0].sale_date == dt.date(2024, 1, 2) and df[0].quantity == 2
    assert df[1].total_amount is None and df[1].sale_date is None and df[1].quantity is None and df[1].unit_price is None
    with pytest.raises(files.MissingInput):
        files.read_raw_csv(spark, str(tmp_path / "missing.csv"))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-500, max_value=500), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, xs):
    v = np.array(xs, dtype=float) / 4.0
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = exact_quantiles(df, "x", (0.25, 0.5, 0.75)).first()
    exp = np.quantile(v, (0.25, 0.5, 0.75))
    assert [round(got[f"q{i}"], 9) for i in range(3)] == [round(e, 9) for e in exp]


def test_exact_quantiles_large_uses_bracket(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([np.full(40000, 5.0), rng.lognormal(3, 2, 30000).round(2)])  # one hot value
    df = spark.createDataFrame([(float(x),) for x in v], "x double").repartition(8)
    f = iqr_fences(df, "x").first()
    q1, q3 = np.quantile(v, (0.25, 0.75))
    assert abs(f.q1 - q1) < 1e-9 and abs(f.q3 - q3) < 1e-9
    assert abs(f.upper - (q3 + 1.5 * (q3 - q1))) < 1e-9


@pytest.mark.parametrize("kind", ["large money", "close doubles", "two clusters", "signs"])
def test_exact_quantiles_of_wide_brackets(spark, kind):
    rng = np.random.default_rng(3)
    v = {
        "large money": (1e9 + rng.integers(0, 2_000_000, 20000) / 100).round(2),
        "close doubles": 1.0 + rng.random(20000) * 1e-9,
        "two clusters": np.concatenate([1.0 + rng.random(5000) * 1e-12, 1.002 + rng.random(15001) * 1e-12]),
        "signs": rng.normal(0, 1e-300, 20000),
    }[kind]
    df = spark.createDataFrame([(float(x),) for x in v], "x double").repartition(8)
    got = exact_quantiles(df, "x", (0.25, 0.5, 0.75)).first()
    s = np.sort(v)
    for i, p in enumerate((0.25, 0.5, 0.75)):
        pos = p * (len(s) - 1)
        lo, hi = s[int(np.floor(pos))], s[int(np.ceil(pos))]
        assert got[f"q{i}"] == (lo if lo == hi else lo + (hi - lo) * (pos - np.floor(pos)))


def test_hot_duplicate_group_matches_window_semantics(spark):
    # one order id holds a third of all rows; the join form must equal the window form
    rows = [(i, "HOT" if i % 3 == 0 else f"O{i % 50}", float(i % 97 + 1), D, "x") for i in range(3000)]
    raw = feed(spark, rows).repartition(8)
    via_join = {r.load_seq for r in cleaning.mark_first_arrival(raw, P).where("_first").collect()}
    via_window = {r.load_seq for r in raw.withColumn("rn", cleaning.arrival_rank(P)).where("rn = 1").collect()}
    assert via_join == via_window and len(via_join) == 51


def test_fixture_arrival_key_is_unique_per_order(spark):
    from conftest import SF_SMALL
    from ledgerlens.sources import fixture

    r = fixture.raw_sales(spark, SF_SMALL)
    dup = r.groupBy("order_id", "loaded_at", "load_seq").count().where("count > 1").count()
    assert dup == 0


def test_result_does_not_depend_on_partitioning(spark):
    rows = [(i, f"O{i % 700}", float((i * 37) % 991 + 1), dt.date(2023 + i % 2, 1 + i % 12, 1 + i % 28), "fashion") for i in range(2000)]
    rows.append((5000, "BIG", 1e6, D, "fashion"))
    base = feed(spark, rows)
    outs = []
    for n in (1, 7):
        c = cleaning.clean(base.repartition(n), P)
        outs.append(sorted((r.order_id, float(r.total_amount)) for r in c.select("order_id", "total_amount").collect()))
    assert outs[0] == outs[1] and len(outs[0]) == 700


def test_hot_order_id_is_split_by_aqe_skew_join(spark):
    """One order id holds a third of the rows: the dedup join is planned skew-aware and stays exact."""
    from pyspark.sql import functions as F

    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 60000
        rows = [(i, "HOT" if i % 3 == 0 else f"O{i % 20000}", float(i % 97 + 1), D, "x") for i in range(n)]
        raw = feed(spark, rows).repartition(8)
        firsts = cleaning.mark_first_arrival(raw, P).where("_first").select("order_id", "load_seq")
        got = {r.order_id: r.load_seq for r in firsts.collect()}
        plan = firsts._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert len(got) == 20001 and got["HOT"] == 0 and got["O1"] == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_csv_reader_accepts_globs(spark, tmp_path):
    hdr = ",".join(f.name for f in S.RAW_CSV.fields)
    for i in range(2):
        (tmp_path / f"part{i}.csv").write_text(hdr + f"\nORD{i},n,e,p,prod,Fashion,1,1,0,0,1.00,UPI,North,Delhi,2024-01-02,Delivered,s\n")
    assert files.read_raw_csv(spark, str(tmp_path / "part*.csv")).count() == 2
    with pytest.raises(files.MissingInput):
        files.read_raw_csv(spark, str(tmp_path / "nothing*.csv"))


def _stored_feed(spark, name):
    from ledgerlens.session import scratch_path

    path = scratch_path(spark, name)
    rows = [(i, None if i % 53 == 0 else f"O{i % 900}", float((i * 37) % 991 + 1), D, f" t-SHIRT {i % 5}") for i in range(1500)]
    files.write_raw(feed(spark, rows).repartition(3), path)
    return files.read_raw(spark, path), path


@pytest.mark.parametrize("broadcast", [True, False])
def test_kept_rows_do_not_move_whole_rows(spark, tmp_path, monkeypatch, broadcast):
    raw, _ = _stored_feed(spark, f"kept_rows_{broadcast}")
    if not broadcast:
        monkeypatch.setattr(cleaning, "BROADCAST_BLOCKS", 0)
    reasons = cleaning.write_reasons(raw, P, str(tmp_path / "reasons"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large table
    try:
        kept = cleaning.kept_rows(raw, reasons)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin" in plan) != broadcast and ("Exchange hashpartitioning" in plan) != broadcast
    want = reasons.where("drop_reason is null").join(raw, "row_id", "left_semi").select("order_id", "total_amount")
    got = sorted((r.order_id, r.total_amount) for r in kept.select("order_id", "total_amount").collect())
    assert got == sorted((r.order_id, r.total_amount) for r in want.collect()) and len(got) > 800
    assert set(kept.columns) == set(raw.columns) - {"row_id"}


@pytest.mark.parametrize("values", [100_000, 0])
def test_text_is_standardised_once_a_value(spark, monkeypatch, values):
    monkeypatch.setattr(cleaning, "BROADCAST_VALUES", values)
    raw, _ = _stored_feed(spark, f"text_values_{values}")
    rows = cleaning.fill_defaults(raw)
    texts = cleaning.text_values(rows)
    assert texts.where("column = 'category'").count() == 5
    got = cleaning.finish(rows, texts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan and "initcap" not in plan) == (values > 0)
    want = cleaning.finish(rows)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_only_repeated_ids_are_joined_back(spark):
    raw = feed(spark, [(i, f"O{i}" if i else None, 1.0, D, "x") for i in range(50)] + [(60, "O7", 1.0, D, "x"), (61, None, 1.0, D, "x")])
    marked = cleaning.mark_first_arrival(raw, P)
    assert "_copies" in marked._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.load_seq for r in marked.where("not _first").collect()) == [60, 61] and marked.count() == 52
