"""Command line: batch job then one mart command, on the smallest supplied tables."""

import os

from conftest import SF_SMALL

from ledgerlens.__main__ import main
from ledgerlens.sources import files


def test_batch_then_kpis(spark, tmp_path):
    out = str(tmp_path / "out")
    assert main(["batch", "--tables", SF_SMALL, "--out", out, "--master", "local[*]"]) == 0
    assert main(["kpis", "--tables", SF_SMALL, "--out", out, "--master", "local[*]"]) == 0
    k = files.read_table(spark, os.path.join(out, "kpis", "kpi_summary")).first()
    assert k.total_orders > 0 and k.top_category is not None
