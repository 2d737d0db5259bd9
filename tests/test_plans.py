"""Physical plan checks: pushdown and pruning reach the Parquet scan of the cleaned table."""

import time

from conftest import SF_SMALL
from ledgerlens import schema as S
from ledgerlens.operators import kpis, trends
from ledgerlens.plans import catalog
from ledgerlens.session import REMOVE_SHUFFLES, scratch_path, set_conf
from ledgerlens.sources import files


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_delivered_filter_and_pruning_reach_the_scan(spark):
    path = scratch_path(spark, "plan_test_cleaned")
    files.write_cleaned(catalog.clean(spark, SF_SMALL), path)
    c = files.read_table(spark, path)
    plan = _plan(kpis.category_revenue(c))
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,Delivered)" in plan
    assert "ReadSchema: struct<category:string,total_amount:decimal(12,2),order_status:string>" in plan
    plan2 = _plan(trends.monthly_trend(c).where("year = 1997"))
    assert "PartitionFilters: [isnotnull(year" in plan2 and "(year#" in plan2


def test_dimension_tables_are_broadcast(spark):
    plan = _plan(catalog.raw(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_raw_rows_are_numbered_without_moving_them(spark, tmp_path):
    from ledgerlens.operators import cleaning
    from ledgerlens.sources import fixture

    path = scratch_path(spark, "plan_test_raw")
    files.write_raw(catalog.raw(spark, SF_SMALL), path)
    raw = files.read_raw(spark, path)
    assert "Exchange" not in _plan(raw) and raw.select("row_id").distinct().count() == raw.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large table
    try:
        plan = _plan(cleaning.mark_first_arrival(raw, fixture.fixture_params()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the whole rows move once, to the join by order_id; the other two are the first arrivals
    assert plan.count("Exchange hashpartitioning") == 3 and "SortMergeJoin" in plan
    drops = str(tmp_path / "drops")
    catalog.raw(spark, SF_SMALL).select(*catalog.RAW_COLS_NO_SEQ).repartition(4).write.option("header", True).csv(drops)
    plan = _plan(files.read_raw_csv(spark, drops))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" in plan


def test_a_large_csv_file_is_numbered_in_order(spark, tmp_path):
    names = [f.name for f in S.RAW_CSV.fields]
    with open(tmp_path / "big.csv", "w") as fh:
        fh.write(",".join(names) + "\n")
        for i in range(30_000):
            fh.write(f"O{i:06d}" + "," * (len(names) - 1) + "\n")
    (tmp_path / "small.csv").write_text(",".join(names) + "\nX" + "," * (len(names) - 1) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = files.read_raw_csv(spark, [str(tmp_path / "big.csv"), str(tmp_path / "small.csv")])
        assert rows.rdd.getNumPartitions() > 5
        got = [(r.load_seq, r.order_id) for r in rows.select("load_seq", "order_id").where("order_id <> 'X'").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({seq for seq, _ in got}) == 30_000 and [o for _, o in sorted(got)] == [f"O{i:06d}" for i in range(30_000)]


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_key_aggregates_by_hash_not_sort(spark):
    from ledgerlens.operators import cleaning
    from ledgerlens.sources import fixture

    t = cleaning.mark_first_arrival(catalog.raw(spark, SF_SMALL), fixture.fixture_params())
    plan = _plan(t)
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_top_keys_read_the_table_once(spark):
    c = catalog.clean(spark, SF_SMALL)
    plan = _final_plan(kpis.top_performers(c))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "Expand" in final


def test_customer_features_read_the_sales_once_without_object_aggregates(spark):
    from ledgerlens.operators import customers

    plan = _final_plan(customers.customer_features(catalog.clean(spark, SF_SMALL))).split("== Initial Plan ==")[0]
    assert "ObjectHashAggregate" not in plan
    # the sales, and the one column of the reference date
    assert plan.count("FileScan parquet") == 2


def test_churn_reads_written_features_only(spark):
    _, held_out, scored, feats = catalog._churn(spark, SF_SMALL)
    for df in (held_out, scored, feats):
        assert "cleaned_sales" not in _plan(df)


def test_columns_of_customers_do_not_move_with_the_lines(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        plan = _plan(catalog.raw(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # lines and part are joined below the join with the orders
    assert plan.index("hashpartitioning(l_orderkey") < plan.index("hashpartitioning(l_partkey") < plan.index("hashpartitioning(o_orderkey")


def test_drops_of_a_large_feed_follow_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "SMALL_FEED", 0)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        catalog.write_drops(spark, SF_SMALL, str(tmp_path / "drops"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "drops").glob("part-*.csv"))) == 8  # the tasks of the last join
    assert spark.read.option("header", True).csv(str(tmp_path / "drops")).count() == catalog.raw(spark, SF_SMALL).count()


def test_stream_ingest_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    """The drops are compressed, and the shuffles of the join do not stay while they are loaded."""
    from ledgerlens.streaming import ingest

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f for f in str(disk.getAllFiles().mkString(" ")).split() if "/shuffle_" in f}

    left = []

    def loads(*args, start=ingest.start_ingest):
        until = time.time() + 20  # they are removed in the background
        while shuffles() - before and time.time() < until:
            time.sleep(0.2)
        left.extend(shuffles() - before)
        return start(*args)

    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name.split("_")[0]))
    monkeypatch.setattr(ingest, "start_ingest", loads)
    with set_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):  # as for large tables
        before = shuffles()
        n = catalog.s01_s03_stream_ingest(spark, SF_SMALL).count()
    assert n == catalog.raw(spark, SF_SMALL).count() and not left
    assert spark.conf.get(REMOVE_SHUFFLES) == "false"
    catalog.write_drops(spark, SF_SMALL, str(tmp_path / "plain"))
    assert files.size(spark, str(tmp_path / "stream" / "drops")) * 3 < files.size(spark, str(tmp_path / "plain"))


def test_whole_rows_move_once_before_the_cleaned_table(spark):
    """The exchange by month has the feed's columns, not those that cleaning derives."""
    from ledgerlens.operators import cleaning

    raw = files.read_raw(spark, f"{catalog._tables(spark, SF_SMALL)}/raw_sales")
    kept = files.by_month(cleaning.kept_rows(raw, catalog.tagged(spark, SF_SMALL)))
    plan = _plan(cleaning.finish(kept, cleaning.text_values(cleaning.fill_defaults(raw))))
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1 and plan.index("revenue_band") < plan.index("REBALANCE_PARTITIONS_BY_COL")
