"""Batch job (J1): load -> clean/save -> KPI -> forecast -> MIS tables.

One Spark application. The raw feed is written once (S3) and the cleaning
stage reads that table; the cleaned table is written once (S7) partitioned
by (year, month), and rolled up once by day, category, region and status. The
additive marts read the roll-up, the others the cleaned table (column pruning
and the status filter reach the Parquet scan). Written tables also cut
lineage, so a lost executor recomputes from the last table, not from the
sources. Every table is verified before it replaces the one before (S8).

As in the reference, a failure in load or clean stops the run; KPI,
forecast and MIS failures are recorded and the run continues.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from ledgerlens import schema as S
from ledgerlens.operators import cleaning, forecast, kpis, reports, rollup
from ledgerlens.session import scratch_path
from ledgerlens.sources import files, fixture

STEP_SCHEMA = "step string, status string, rows long, seconds double, detail string"


# Steps whose failure ends the run.
CRITICAL = ("load", "clean")


class StepFailed(RuntimeError):
    pass


def clean_and_save(spark: SparkSession, raw: DataFrame, path: str, params: S.Params, reasons_path: str | None = None) -> dict:
    """C1-C10 + S7: reasons of all rows on narrow columns, then the cleaned table from the survivors.

    Jobs: (1) feed -> C1-C6 reasons -> narrow table; (2) fences from two
    columns of that table; (3) surviving rows -> cleaned table partitioned by
    (year, month), the one time that whole rows are written; (4) the C11
    report, an aggregate over the reasons. The rows written must be those
    that the report says are left.
    """
    reasons_path = reasons_path or scratch_path(spark, f"sales_reasons_{uuid.uuid4().hex[:12]}")
    reasons = cleaning.write_reasons(raw, params, reasons_path)
    # whole rows move here only, and without the columns that ``finish`` derives
    kept = files.by_month(cleaning.kept_rows(raw, reasons))
    texts = cleaning.text_values(cleaning.fill_defaults(raw))
    written = files.write_cleaned(cleaning.finish(kept, texts), path, arranged=True)
    report = cleaning.cleaning_report(reasons).first().asDict()
    if written != report["final_rows"]:
        raise files.UnverifiedWrite(f"{path}: {written} rows written, {report['final_rows']} left by the report")
    return report


def run(spark: SparkSession, sf_dir: str, out_dir: str, params: S.Params | None = None, csv: str | None = None) -> DataFrame:
    """Step rows (name, status, rows, seconds, detail); ``csv`` names a raw CSV feed instead of the supplied tables."""
    params = params or fixture.fixture_params()
    out = out_dir.rstrip("/")
    steps: list[tuple] = []

    def step(name, fn, critical):
        t = time.time()
        try:
            rows, detail = fn()
            steps.append((name, "ok", rows, round(time.time() - t, 3), detail))
        except Exception as e:  # noqa: BLE001 - the job records the failure like the reference
            steps.append((name, "failed", None, round(time.time() - t, 3), str(e)))
            if critical:
                raise StepFailed(name) from e

    def load():
        source = fixture.raw_sales(spark, sf_dir) if csv is None else files.coerce_raw(files.read_raw_csv(spark, csv))
        return files.write_raw(source, f"{out}/raw_sales"), "raw_sales written"

    def clean():
        raw = files.read_raw(spark, f"{out}/raw_sales")
        rep = clean_and_save(spark, raw, f"{out}/cleaned_sales", params)
        rollup.write(files.read_table(spark, f"{out}/cleaned_sales"), f"{out}/sales_rollup")
        return rep["final_rows"], str(rep)

    def tables():
        return files.read_table(spark, f"{out}/cleaned_sales"), files.read_table(spark, f"{out}/sales_rollup")

    def kpi():
        c, r = tables()
        for name, df in (("kpi_monthly_revenue", kpis.monthly(r)), ("kpi_category_revenue", kpis.category_revenue(r))):
            files.write_table(df, f"{out}/{name}")
        return files.write_table(kpis.kpi_summary(r, c), f"{out}/kpi_summary"), "kpi_summary and its monthly and category tables written"

    def fcst():
        _, r = tables()
        return files.write_table(forecast.forecast(r, params.forecast_days), f"{out}/sales_forecast"), "sales_forecast written"

    def mis():
        c, r = tables()
        n = 0
        for name, df in (
            ("mis_summary", reports.mis_summary(r)),
            ("mis_monthly", reports.mis_monthly(r)),
            ("mis_categories", reports.mis_categories(r)),
            ("mis_data", reports.mis_data(c)),
        ):
            n += files.write_table(df, f"{out}/{name}")
        return n, "MIS tables written"

    try:
        step("load", load, True)
        step("clean", clean, True)
        step("kpi", kpi, False)
        step("forecast", fcst, False)
        step("mis", mis, False)
    except StepFailed:
        pass
    return spark.createDataFrame(steps, STEP_SCHEMA)
