"""Benchmark: the batch job's stages and headline marts at one scale.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints ONE JSON line. Every timing is a full execution (``noop`` sink or a
real write), never a ``collect`` of a large result.

* ``load_raw_write``: fixture feed (joins of the source tables) -> raw table (S3);
* ``clean_write``: raw table (``read_raw``, as in the job) -> reasons (C1-C6) ->
  fences (C7) -> cleaned table partitioned by (year, month) (C8-C10, S7) -> report (C11);
* ``rollup_write``: cleaned table -> roll-up by day, category, region, status;
* marts over the roll-up or the cleaned table (what a deployment runs daily);
* ``h10_churn_model``: features, split, fit, evaluation and scores of all customers.

The sum is one end-to-end run: sources -> raw -> cleaned -> every mart.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ledgerlens.operators import churn_model, customers, forecast, impact, kpis, projection, quality, reports, rollup, trends  # noqa: E402
from ledgerlens.plans.batch import clean_and_save  # noqa: E402
from ledgerlens.session import get_spark  # noqa: E402
from ledgerlens.sources import files, fixture  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(app="ledgerlens-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    work = tempfile.mkdtemp(prefix="ledgerlens-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    params = fixture.fixture_params()
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    # Warm-up (not timed): JVM start and JIT, plus generated-code compilation,
    # by running the same job shapes once on the smallest supplied tables.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        files.write_raw(fixture.raw_sales(spark, warm_dir), f"{work}/warm_raw")
        clean_and_save(spark, files.read_raw(spark, f"{work}/warm_raw"), f"{work}/warm_clean", params)
        wc = files.read_table(spark, f"{work}/warm_clean")
        rollup.write(wc, f"{work}/warm_rollup")
        wr = files.read_table(spark, f"{work}/warm_rollup")
        for warm in (kpis.kpi_summary(wr, wc), trends.monthly_trend(wr), impact.score_categories(wr), customers.customer_features(wc), reports.coach_cards(wr, single=wc)):
            _run(warm)
    else:
        _run(fixture.raw_sales(spark, sf_dir).limit(1))

    raw_path, cleaned_path = f"{work}/raw_sales", f"{work}/cleaned_sales"
    timed("load_raw_write", lambda: files.write_raw(fixture.raw_sales(spark, sf_dir), raw_path))
    timed("clean_write", lambda: clean_and_save(spark, files.read_raw(spark, raw_path), cleaned_path, params))
    c = files.read_table(spark, cleaned_path)
    timed("rollup_write", lambda: rollup.write(c, f"{work}/sales_rollup"))
    r = files.read_table(spark, f"{work}/sales_rollup")

    marts = {
        "k12_kpi_summary": lambda: kpis.kpi_summary(r, c),
        "tr02_monthly_trend": lambda: trends.monthly_trend(r),
        "tr03_category_trend": lambda: trends.category_trend(r),
        "i04_category_score": lambda: impact.score_categories(r),
        "i06_region_score": lambda: impact.score_regions(r),
        "h01_customer_features": lambda: customers.customer_features(c),
        "h15_report_churn": lambda: customers.report_churn(c),
        "v07_quality_score": lambda: quality.score(quality.checks(c, params)),
        "f01_daily_revenue": lambda: projection.daily_revenue(r),
        "f02_forecast": lambda: forecast.forecast(r, params.forecast_days),
        "f09_category_projection": lambda: projection.category_projection(r),
        "r01_mis_summary": lambda: reports.mis_summary(r),
        "r04_mis_data": lambda: reports.mis_data(c),
        "r11_coach_cards": lambda: reports.coach_cards(r, single=c),
    }
    for name, build in marts.items():
        timed(name, lambda b=build: _run(b()))

    def churn():
        feats = files.scratch_table(customers.customer_features(c), "customer_features")
        model, held_out = churn_model.train(feats)
        churn_model.evaluate(model, held_out, spark).collect()
        _run(churn_model.score(model, feats))

    timed("h10_churn_model", churn)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
