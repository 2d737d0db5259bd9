"""Batch job (J1): every step succeeds, and its written tables agree with the marts."""

import os

from conftest import SF_SMALL

from ledgerlens.operators import kpis
from ledgerlens.plans import batch
from ledgerlens.sources import files


def test_batch_job_writes_consistent_tables(spark, tmp_path):
    out = str(tmp_path / "job")
    steps = {r.step: r for r in batch.run(spark, SF_SMALL, out).collect()}
    assert [s for s in ("load", "clean", "kpi", "forecast", "mis") if steps[s].status != "ok"] == []
    raw_n = files.read_table(spark, os.path.join(out, "raw_sales")).count()
    clean = files.read_table(spark, os.path.join(out, "cleaned_sales"))
    assert steps["load"].rows == raw_n and steps["clean"].rows == clean.count() < raw_n
    written = files.read_table(spark, os.path.join(out, "kpi_summary")).first().asDict()
    fresh = kpis.kpi_summary(clean).first().asDict()
    assert written == fresh
    assert files.read_table(spark, os.path.join(out, "sales_forecast")).count() == 90
    # one whole copy of the cleaned rows, and no other table of their width
    assert sorted(d for d in os.listdir(out) if d.startswith(("cleaned", "sales"))) == ["cleaned_sales", "sales_forecast", "sales_rollup"]
    rolled = files.read_table(spark, os.path.join(out, "sales_rollup")).agg({"n_rows": "sum"}).first()[0]
    assert rolled == clean.count()
