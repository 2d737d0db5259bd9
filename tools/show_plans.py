"""Print the formatted physical plans of the batch stages and headline marts.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlens.operators import cleaning, customers, kpis, trends  # noqa: E402
from ledgerlens.plans import catalog  # noqa: E402
from ledgerlens.session import get_spark  # noqa: E402
from ledgerlens.sources import fixture  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    raw = fixture.raw_sales(spark, sf)
    c = catalog.clean(spark, sf)
    plans = {
        "load: fixture feed (S3 input)": raw,
        "tag C1-C6 (over the feed)": cleaning.tag_pre_fence(raw, fixture.fixture_params()),
        "K1-K9 headline": kpis.headline(c),
        "K8 top keys (one grouping-sets scan)": kpis.top_performers(c),
        "K10 category revenue": kpis.category_revenue(c),
        "TR1/TR2 monthly trend": trends.monthly_trend(c),
        "H1-H6 customer features": customers.customer_features(c),
    }
    for name, df in plans.items():
        print(f"\n===== {name} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
