"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlens.operators import cleaning
from ledgerlens.plans import catalog
from oracle_harness import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r.get("first_diffs")


def test_every_query_has_a_known_kind():
    rows_only = set(catalog.QUERIES) - set(catalog.SQL)
    assert rows_only <= {n for n in catalog.QUERIES if n[:3] in ("h08", "h09", "h10", "h11", "h12", "h13", "h14", "f02", "f04", "f05", "f10", "s09", "j01")}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "mom_growth_pct" in df.columns


def test_every_rule_fires_on_the_dirty_feed(spark):
    report = catalog.QUERIES["c11_dirty_feed"](spark, SF_SMALL).first().asDict()
    assert min(report[k] for k in cleaning.REPORT_KEYS.values()) > 0
    checks = {r["check"]: r["violations"] for r in catalog.QUERIES["v01_v06_dirty_feed"](spark, SF_SMALL).collect()}
    assert min(n for check, n in checks.items() if not check.startswith("Row count")) > 0
