"""Adapter: the supplied TPC-H-style tables as the ``raw_sales`` feed.

One raw sale = one ``lineitem`` row, enriched with its order, customer
(nation -> city, region -> region) and part (name, type -> category).
The mapping is documented in FIXTURES.md and mirrored by the oracle SQL in
``ledgerlens.plans.oracle.RAW_SALES_SQL``; the two must stay in step.

Defects the cleaning stage has to handle come from the data itself:

* ``order_id`` is ``ORD<orderkey>-<linenumber>``; that pair repeats in the
  feed, so the same order id arrives more than once (C1).
* customers with a negative account balance have no e-mail on file (C3).
* lines of orders dated after the report date are future-dated (C5, V4).
* raw text is upper case (``ECONOMY``, ``MIDDLE EAST``, ``1-URGENT``) and is
  title-cased by C8.

Join shape (chosen for the 100 TB case): orders are enriched with customer,
nation and region first (order-sized shuffle on custkey; nation/region are
25/5-row dimensions the planner broadcasts by size). Lineitem, cut to the
types of the feed, meets part first (fact-sized shuffle on partkey) and then
the enriched orders (on orderkey), so the wide columns of customers never
move with the lines, and the lines of an order come out side by side, which
Parquet and later shuffles compress well. Outer joins keep every feed line,
as the reference keeps every CSV row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.sources.tables import table

# Fixed parameters for the supplied fixture: its business calendar starts on
# the first order date and the reporting date is mid-2001 (the feed still
# contains July/August 2001 orders, which are therefore future-dated).
FIXTURE_MIN_DATE = dt.date(1995, 1, 1)
FIXTURE_AS_OF = dt.date(2001, 6, 30)
FIXTURE_CATEGORIES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard")
FIXTURE_DEDUP_ORDER = ("loaded_at", "load_seq")


def fixture_params() -> S.Params:
    return S.Params(
        as_of=FIXTURE_AS_OF,
        min_date=FIXTURE_MIN_DATE,
        allowed_categories=FIXTURE_CATEGORIES,
        dedup_order=FIXTURE_DEDUP_ORDER,
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.col("l_extendedprice").cast(S.MONEY)
    disc = F.col("l_discount").cast("decimal(4,2)")
    disc_amt = (F.col("_ext") * F.col("_disc")).cast(S.MONEY)
    # of the line alone; the order's own status counts where this is NULL
    line_status = F.when(F.col("l_returnflag") == "R", "RETURNED").when(F.col("l_linestatus") == "F", "DELIVERED")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"),
        ext.alias("_ext"), disc.alias("_disc"), line_status.alias("_status"), F.col("l_shipdate").cast("timestamp_ntz").alias("loaded_at"),
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("sale_date"), "o_orderpriority"
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.col("p_retailprice").cast(S.MONEY).alias("unit_price"))

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    cust_geo = cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
    orders_x = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey, "left")

    j = li.join(part, li.l_partkey == part.p_partkey, "left").join(
        orders_x, li.l_orderkey == orders_x.o_orderkey, "left"
    )

    status = F.coalesce(F.col("_status"), F.when(F.col("o_orderstatus") == "P", "CANCELLED").otherwise("PENDING"))
    email = F.when(
        F.col("c_acctbal") >= 0,
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")),
    )
    return j.select(
        (F.col("l_partkey") * F.lit(1_000_000) + F.col("l_suppkey")).alias("load_seq"),
        F.concat(F.lit("ORD"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("c_name").alias("customer_name"),
        email.alias("customer_email"),
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("customer_phone"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        "unit_price",
        "quantity",
        (F.col("_disc") * F.lit(100)).cast(S.PCT).alias("discount_pct"),
        disc_amt.alias("discount_amt"),
        (F.col("_ext") - disc_amt).cast(S.MONEY).alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        "sale_date",
        status.alias("order_status"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("salesperson"),
        "loaded_at",
    )


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a CSV delivers it, fields as text, with faults set by column rules (see FIXTURES.md).

    ``files.coerce_raw`` types it; ``ledgerlens.plans.oracle.DIRTY_SALES_SQL``
    states the typed result.
    """
    r = raw_sales(spark, sf_dir)
    q, status, discount = F.col("quantity"), F.col("order_status"), F.col("discount_pct")
    amount, day, category = (F.col(c).cast("string") for c in ("total_amount", "sale_date", "category"))
    faults = {
        "order_id": F.when((q != 49) | (discount != 10), F.col("order_id")),
        "total_amount": F.when((status == "PENDING") & (q % 7 == 0), "")
        .when(q == 18, "n/a")
        .when((status == "RETURNED") & (q % 5 == 0), F.concat(F.lit("-"), amount))
        .when((q == 50) & (discount == 0), (F.col("total_amount") * 40).cast(S.MONEY).cast("string"))
        .otherwise(amount),
        "sale_date": F.when(q == 13, "not a date").when(q == 14, F.concat(day, F.lit(" 10:30:00"))).otherwise(day),
        "category": F.when(q == 12, F.concat(F.lit("\u00a0 \t"), F.lower(category), F.lit("\u3000"))).when(q != 11, category),
        "region": F.when(q != 19, F.col("region")),
        "quantity": F.when(q < 10, F.concat(q.cast("string"), F.lit(".0"))).when(q == 20, "2.5").otherwise(q.cast("string")),
        "discount_pct": F.when(q != 16, discount.cast("string")),
        "payment_method": F.when(q != 17, F.col("payment_method")),
    }
    kept = ("load_seq", "loaded_at")
    return r.select(*[F.col(c) if c in kept else faults.get(c, F.col(c).cast("string")).alias(c) for c in r.columns])
