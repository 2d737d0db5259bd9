"""Registered queries: one per operator ID of the inventory, each with its oracle SQL.

Every query reads the supplied tables through the fixture adapter
(``raw_sales``) and runs the real cleaning stage before its mart, so its
work grows with the input. Queries whose result depends on a trained model
or on a fitted forecast have no oracle SQL (rows-only check).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import (
    churn_model,
    cleaning,
    customers,
    forecast,
    impact,
    kpis,
    projection,
    quality,
    quantile,
    reports,
    rollup,
    trends,
)
from ledgerlens.plans import oracle as O
from ledgerlens.session import REMOVE_SHUFFLES, scratch_path, set_conf
from ledgerlens.sources import files, fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _as_double_sql(sql: str, cols: tuple[str, ...]) -> str:
    repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"


def _as_double(fn: Query, cols: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = fn(spark, sf)
        return df.withColumns({c: F.col(c).cast("double") for c in cols})

    run.__doc__ = fn.__doc__
    return run


def register(name: str, sql: str | None = None, money: tuple[str, ...] = ()):
    """Register a query and its oracle SQL.

    ``money`` lists DECIMAL output columns that are presented as DOUBLE on
    both sides (the stored tables keep DECIMAL(12,2)); Python receives
    DECIMAL as ``Decimal`` from Spark but as ``float`` from DuckDB.
    """

    def deco(fn: Query) -> Query:
        QUERIES[name] = _as_double(fn, money) if money else fn
        if sql is not None:
            SQL[name] = _as_double_sql(sql, money) if money else sql
        return fn

    return deco


MONEY4 = ("unit_price", "discount_pct", "discount_amt", "total_amount")


def _tag(sf: str) -> str:
    return hashlib.sha1(sf.encode()).hexdigest()[:10]


def params() -> S.Params:
    return fixture.fixture_params()


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.raw_sales(spark, sf)


def dirty_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The feed with faults, typed by S2."""
    return files.coerce_raw(fixture.dirty_feed(spark, sf))


_BUILT: dict = {}


def _tables(spark: SparkSession, sf: str, dirty: bool = False) -> str:
    """Run load + cleaning once per (session, input); returns the folder of raw_sales, cleaned_sales and sales_reasons.

    Marts then read the written cleaned table, as a deployment does: Parquet
    scans with pushed filters and pruned columns, lineage cut at the table.
    ``dirty`` starts from the feed with faults, read as text and coerced.
    """
    from ledgerlens.plans.batch import clean_and_save

    key = (spark.sparkContext.applicationId, sf, dirty)
    if key not in _BUILT:
        base = scratch_path(spark, f"catalog_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
        # S3: the feed lands as the raw table first, as in the batch job
        files.write_raw(dirty_raw(spark, sf) if dirty else raw(spark, sf), f"{base}/raw_sales")
        raw_t = files.read_raw(spark, f"{base}/raw_sales")
        clean_and_save(spark, raw_t, f"{base}/cleaned_sales", params(), f"{base}/sales_reasons")
        _BUILT[key] = base
    return _BUILT[key]


def pre_tagged(spark: SparkSession, sf: str, dirty: bool = False) -> DataFrame:
    """C1-C6 tags of every raw row, with defaults."""
    return cleaning.tag_pre_fence(files.read_raw(spark, f"{_tables(spark, sf, dirty)}/raw_sales"), params())


def reasons(spark: SparkSession, sf: str, dirty: bool = False) -> DataFrame:
    """C1-C6 reasons as they are written: row_id, order_id, total_amount, drop_reason."""
    return spark.read.parquet(f"{_tables(spark, sf, dirty)}/sales_reasons")


def tagged(spark: SparkSession, sf: str, dirty: bool = False) -> DataFrame:
    """The same with the final ``drop_reason``."""
    return cleaning.read_reasons(spark, f"{_tables(spark, sf, dirty)}/sales_reasons", params())


def clean(spark: SparkSession, sf: str, dirty: bool = False) -> DataFrame:
    """The cleaned sales table (written once, read per query)."""
    return files.read_table(spark, f"{_tables(spark, sf, dirty)}/cleaned_sales")


_ROLLED: set = set()


def rolled(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-up of the cleaned sales (written once), which the additive marts read."""
    path = f"{_tables(spark, sf)}/sales_rollup"
    if path not in _ROLLED:
        rollup.write(clean(spark, sf), path)
        _ROLLED.add(path)
    return files.read_table(spark, path)


q = O.q

# ---------------------------------------------------------------------------
# Shared oracle CTEs
# ---------------------------------------------------------------------------
MONTHLY = """m AS (SELECT year, month, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(order_id) AS orders
  FROM delivered WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month)"""
MOM = MONTHLY + """,
ml AS (SELECT *, lag(revenue) OVER (ORDER BY year, month) AS prev, COUNT(*) OVER () AS n_months,
  row_number() OVER (ORDER BY year DESC, month DESC) AS rk FROM m),
g AS (SELECT
  CASE WHEN n_months >= 2 THEN round_even((revenue - prev) / prev * 100.0, 2) ELSE 0.0 END AS mom_growth_pct,
  CASE WHEN n_months >= 2 THEN round_even(revenue, 2) END AS this_month_rev,
  CASE WHEN n_months >= 2 THEN round_even(prev, 2) END AS last_month_rev,
  CASE WHEN n_months >= 2 THEN (revenue - prev) / prev * 100.0 ELSE 0.0 END AS mom_growth_raw,
  CASE WHEN n_months >= 2 THEN revenue END AS this_month_raw,
  CASE WHEN n_months >= 2 THEN prev END AS last_month_raw,
  n_months
  FROM ml WHERE rk = 1)"""
HEADLINE = f"""hw AS (SELECT
  round_even(COALESCE(CAST(SUM(total_amount) FILTER (WHERE order_status = 'Delivered') AS DOUBLE), 0.0), 2) AS total_revenue,
  COUNT(*) FILTER (WHERE order_status = 'Delivered') AS total_orders,
  COUNT(DISTINCT customer_email) AS total_customers,
  COUNT(*) FILTER (WHERE order_status = 'Returned') AS returned_orders,
  COUNT(*) AS all_orders,
  {O.mean('discount_pct')} AS disc_mean,
  CAST(SUM(discount_amt) AS DOUBLE) AS disc_sum
  FROM clean),
h AS (SELECT total_revenue, total_orders, total_customers,
  round_even(total_revenue / CAST(total_orders AS DOUBLE), 2) AS avg_order_value,
  round_even(CAST(returned_orders AS DOUBLE) / CAST(all_orders AS DOUBLE) * 100.0, 2) AS return_rate_pct,
  returned_orders, all_orders,
  round_even(disc_mean, 2) AS avg_discount_pct,
  round_even(disc_sum, 2) AS total_discount
  FROM hw)"""


def top_sql(key: str, alias: str, desc: bool = True) -> str:
    order = "DESC" if desc else "ASC"
    return (
        f"(SELECT {key} AS {alias} FROM (SELECT {key}, SUM(total_amount) AS r FROM delivered "
        f"WHERE {key} IS NOT NULL GROUP BY {key}) ORDER BY r {order}, {key} ASC LIMIT 1)"
    )


TOPS = f"tops AS (SELECT * FROM {top_sql('category', 'top_category')} CROSS JOIN {top_sql('region', 'top_region')})"


def norm_sql(c: str) -> str:
    mn, mx = f"MIN({c}) OVER ()", f"MAX({c}) OVER ()"
    return f"CASE WHEN {mx} = {mn} THEN 50.0 ELSE round_even(CAST({c} - {mn} AS DOUBLE) / CAST({mx} - {mn} AS DOUBLE) * 100.0, 2) END"


CAT_GROWTH = """cmg AS (SELECT category, year, month, CAST(SUM(total_amount) AS DOUBLE) AS rev FROM delivered
  WHERE category IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL GROUP BY 1, 2, 3),
cml AS (SELECT *, lag(rev) OVER (PARTITION BY category ORDER BY year, month) AS prev,
  COUNT(*) OVER (PARTITION BY category) AS n,
  row_number() OVER (PARTITION BY category ORDER BY year DESC, month DESC) AS rk FROM cmg),
cg AS (SELECT category, CASE WHEN n >= 2 AND prev <> 0 THEN (rev - prev) / prev * 100.0 ELSE 0.0 END AS growth_pct
  FROM cml WHERE rk = 1)"""
CAT_SCORE = CAT_GROWTH + """,
ca AS (SELECT d.category, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(order_id) AS orders
  FROM delivered d WHERE d.category IS NOT NULL GROUP BY d.category),
cj AS (SELECT ca.*, COALESCE(cg.growth_pct, 0.0) AS growth_pct FROM ca LEFT JOIN cg ON ca.category = cg.category),
cn AS (SELECT *, """ + norm_sql("revenue") + """ AS rev_score, """ + norm_sql("growth_pct") + """ AS growth_score,
  """ + norm_sql("orders") + """ AS vol_score FROM cj),
cs AS (SELECT *, round_even(rev_score * 0.5 + growth_score * 0.3 + vol_score * 0.2, 1) AS impact_score FROM cn),
cgr AS (SELECT *, CASE WHEN impact_score >= 75 THEN 'A' WHEN impact_score >= 50 THEN 'B'
  WHEN impact_score >= 25 THEN 'C' ELSE 'D' END AS grade FROM cs)"""
REG_SCORE = f"""ra AS (SELECT region, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(order_id) AS orders,
  {O.mean('total_amount')} AS avg_val FROM delivered WHERE region IS NOT NULL GROUP BY region),
rn AS (SELECT *, {norm_sql('revenue')} AS rev_score, {norm_sql('orders')} AS vol_score, {norm_sql('avg_val')} AS val_score FROM ra),
rs AS (SELECT *, round_even(rev_score * 0.6 + vol_score * 0.25 + val_score * 0.15, 1) AS impact_score FROM rn)"""
CUST = f"""ref AS (SELECT MAX(sale_date) AS ref_date FROM clean),
cu AS (SELECT customer_email, COUNT(order_id) AS total_orders, CAST(SUM(total_amount) AS DOUBLE) AS total_spent,
  {O.mean('total_amount')} AS avg_order_value, MAX(sale_date) AS last_order_date, MIN(sale_date) AS first_order_date,
  {O.mean('discount_pct')} AS avg_discount
  FROM delivered WHERE customer_email IS NOT NULL GROUP BY customer_email),
cf AS (SELECT cu.*, CAST(date_diff('day', last_order_date, ref_date) AS INTEGER) AS days_since_last,
  CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER) AS customer_lifetime FROM cu CROSS JOIN ref),
cfe AS (SELECT *, round_even(total_orders / (customer_lifetime / 30.0 + 1.0), 3) AS order_frequency,
  CAST(days_since_last >= {S.CHURN_DAYS} AS INTEGER) AS churned FROM cf)"""
FAVS = """fc AS (SELECT customer_email, category AS fav_category FROM (SELECT customer_email, category, COUNT(*) AS c
  FROM delivered WHERE customer_email IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_email ORDER BY c DESC, category ASC) = 1),
fr AS (SELECT customer_email, region AS fav_region FROM (SELECT customer_email, region, COUNT(*) AS c
  FROM delivered WHERE customer_email IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_email ORDER BY c DESC, region ASC) = 1)"""
REPORT_CHURN = f"""rref AS (SELECT MAX(sale_date) AS ref_date FROM clean),
lastd AS (SELECT customer_email, MAX(sale_date) AS last_date FROM delivered WHERE customer_email IS NOT NULL GROUP BY 1),
rc AS (SELECT COUNT(*) AS total_customers,
  COUNT(*) FILTER (WHERE last_date < ref_date - INTERVAL {S.CHURN_DAYS} DAY) AS churned_customers FROM lastd CROSS JOIN rref),
ma AS (SELECT {O.mean('total_amount')} AS mean_delivered_amount FROM delivered),
rcx AS (SELECT total_customers, churned_customers,
  COALESCE(round_even(CAST(churned_customers AS DOUBLE) / CAST(total_customers AS DOUBLE) * 100.0, 1), 0.0) AS churn_rate_pct,
  COALESCE(mean_delivered_amount, 0.0) AS mean_delivered_amount,
  churned_customers * COALESCE(mean_delivered_amount, 0.0) AS revenue_at_risk FROM rc CROSS JOIN ma)"""
TAIL = MONTHLY + f""",
mt AS (SELECT *, revenue / lag(revenue) OVER (ORDER BY year, month) - 1.0 AS chg,
  row_number() OVER (ORDER BY year DESC, month DESC) AS rk FROM m),
ts AS (SELECT COUNT(*) AS n_months, AVG(CASE WHEN rk <= 3 THEN revenue END) AS last_3_avg,
  MAX(CASE WHEN rk = 1 THEN revenue END) AS last_month, AVG(CASE WHEN rk <= 3 THEN chg END) AS tail_growth FROM mt),
tg AS (SELECT n_months, COALESCE(last_3_avg, 0.0) AS last_3_avg, COALESCE(last_month, 0.0) AS last_month,
  CASE WHEN n_months >= 2 THEN COALESCE(CASE WHEN tail_growth <> 0 THEN tail_growth END, {S.DEFAULT_GROWTH})
  ELSE {S.DEFAULT_GROWTH} END AS growth FROM ts)"""
CAT_TABLE = """ct AS (SELECT category, SUM(total_amount) AS rev_dec, COUNT(order_id) AS orders FROM delivered
  WHERE category IS NOT NULL GROUP BY category),
ctt AS (SELECT *, SUM(rev_dec) OVER () AS total FROM ct)"""
COACH = HEADLINE + "," + MOM + f""",
cr AS (SELECT CAST(SUM(total_amount) AS DOUBLE) AS total_rev, {O.mean('total_amount')} AS mean_delivered_amount FROM delivered),
cd AS (SELECT CAST(SUM(discount_amt) AS DOUBLE) AS total_disc FROM clean),
cm AS (SELECT h.return_rate_pct, h.avg_discount_pct, COALESCE(cr.total_rev, 0.0) AS total_rev, cd.total_disc,
  round_even(cd.total_disc / cr.total_rev * 100.0, 2) AS disc_pct_rev, g.mom_growth_raw AS growth,
  h.returned_orders, h.all_orders, cr.mean_delivered_amount
  FROM h CROSS JOIN cr CROSS JOIN cd CROSS JOIN g)"""


def _sel(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


# ---------------------------------------------------------------------------
# S: sources and sinks (round trips through the real writers/readers)
# ---------------------------------------------------------------------------
RAW_COLS_NO_SEQ = [f.name for f in S.RAW_SALES.fields if f.name not in ("load_seq", "loaded_at")]


@register("s01_s02_csv_ingest", q("SELECT " + ", ".join(RAW_COLS_NO_SEQ) + " FROM raw_sales"), money=MONEY4)
def s01_s02_csv_ingest(spark, sf):
    """S1 + S2: the raw feed written as header CSV, read back as text and coerced."""
    path = scratch_path(spark, f"raw_csv_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    r = raw(spark, sf).select(*RAW_COLS_NO_SEQ)
    r.write.mode("overwrite").option("header", True).csv(path)
    back = files.coerce_raw(files.read_raw_csv(spark, path))
    return back.select(*RAW_COLS_NO_SEQ)


# Bytes of lineitem up to which the feed would be written by a few tasks anyway.
SMALL_FEED = 32 << 20
# Most rows of a drop: a compressed one is read by one task, from its start to its end.
DROP_ROWS = 2_000_000


def write_drops(spark: SparkSession, sf: str, path: str, codec: str = "none") -> None:
    """The feed as several CSV drops: one or more from each task that joins it, so that none grows with the feed; four of a small one.

    The shuffles of the joins are removed as soon as the drops are written.
    """
    feed = raw(spark, sf).select(*RAW_COLS_NO_SEQ)
    if files.size(spark, f"{sf}/lineitem.parquet") <= SMALL_FEED:
        feed = feed.repartition(4)
    out = feed.write.option("header", True).option("compression", codec).option("zlib.compress.level", "BEST_SPEED")
    with set_conf(spark, REMOVE_SHUFFLES, "true"):
        out.option("maxRecordsPerFile", DROP_ROWS).csv(path)


@register("s01_s03_stream_ingest", q("SELECT " + ", ".join(RAW_COLS_NO_SEQ) + " FROM raw_sales"), money=MONEY4)
def s01_s03_stream_ingest(spark, sf):
    """S1-S3 incrementally: the feed dropped as CSV files, loaded by a Structured Streaming run."""
    from ledgerlens.streaming import ingest

    base = scratch_path(spark, f"stream_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    write_drops(spark, sf, f"{base}/drops", "gzip")
    q_ = ingest.start_ingest(spark, f"{base}/drops", f"{base}/raw_sales", f"{base}/_checkpoint")
    q_.awaitTermination()
    return ingest.read_ingested(spark, f"{base}/raw_sales").select(*RAW_COLS_NO_SEQ)


@register("s03_s04_raw_table", q("SELECT * FROM raw_sales"), money=MONEY4)
def s03_s04_raw_table(spark, sf):
    """S3 + S4: replace the raw table with the declared schema, then scan it."""
    path = scratch_path(spark, f"raw_sales_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    files.write_raw(raw(spark, sf), path)
    return files.read_raw(spark, path).drop("row_id")


def _written_clean(spark, sf) -> tuple[str, int]:
    path = scratch_path(spark, f"cleaned_sales_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    n = files.write_cleaned(clean(spark, sf), path)
    return path, n


@register("s05_s07_cleaned_table", q("SELECT * FROM clean"), money=MONEY4)
def s05_s07_cleaned_table(spark, sf):
    """S7 + S5: write the cleaned table partitioned by (year, month) and scan it."""
    path, _ = _written_clean(spark, sf)
    return files.read_table(spark, path)


@register("s06_delivered_scan", q("SELECT * FROM delivered"), money=MONEY4)
def s06_delivered_scan(spark, sf):
    """Delivered rows of the written cleaned table (status filter pushed into the scan)."""
    path, _ = _written_clean(spark, sf)
    return files.read_delivered(spark, path)


@register("s08_verify_count", q("SELECT 'cleaned' AS \"table\", COUNT(*) AS written_rows, COUNT(*) AS read_back_rows, true AS ok FROM clean"))
def s08_verify_count(spark, sf):
    """Written row count (observed during the write) against the read-back count."""
    path, n = _written_clean(spark, sf)
    return files.verify_count(spark, path, n).withColumn("table", F.lit("cleaned"))


@register("s09_predictions_csv")
def s09_predictions_csv(spark, sf):
    """Churn predictions written as header CSV and read back."""
    scored = _churn(spark, sf)[2]
    path = scratch_path(spark, f"churn_predictions_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    files.write_csv(scored, path)
    return spark.read.option("header", True).csv(path)


# ---------------------------------------------------------------------------
# C: cleaning
# ---------------------------------------------------------------------------
RN = "row_number() OVER (PARTITION BY order_id ORDER BY loaded_at ASC NULLS LAST, load_seq ASC NULLS LAST)"


@register("c01_dedup_first_arrival", q(f"SELECT order_id, loaded_at, load_seq, total_amount FROM raw_sales QUALIFY {RN} = 1"), money=("total_amount",))
def c01(spark, sf):
    r = cleaning.mark_first_arrival(raw(spark, sf), params())
    return r.where("_first").select("order_id", "loaded_at", "load_seq", "total_amount")


@register(
    "c02_drop_null_critical",
    q("SELECT order_id, total_amount, sale_date FROM pre WHERE drop_reason IS NULL OR drop_reason NOT IN ('duplicate', 'null_critical')"),
    money=("total_amount",),
)
def c02(spark, sf):
    t = pre_tagged(spark, sf)
    return t.where(F.col("drop_reason").isNull() | ~F.col("drop_reason").isin("duplicate", "null_critical")).select(
        "order_id", "total_amount", "sale_date"
    )


@register(
    "c03_fill_defaults",
    q(
        f"""SELECT order_id, COALESCE(customer_email, '{S.FILL_EMAIL}') AS customer_email,
  COALESCE(discount_pct, CAST(0 AS DECIMAL(5,2))) AS discount_pct, COALESCE(discount_amt, CAST(0 AS DECIMAL(12,2))) AS discount_amt,
  COALESCE(payment_method, '{S.FILL_PAYMENT}') AS payment_method
  FROM pre WHERE drop_reason IS NULL OR drop_reason NOT IN ('duplicate', 'null_critical')"""
    ),
    money=("discount_pct", "discount_amt"),
)
def c03(spark, sf):
    t = pre_tagged(spark, sf)
    return t.where(F.col("drop_reason").isNull() | ~F.col("drop_reason").isin("duplicate", "null_critical")).select(
        "order_id", "customer_email", "discount_pct", "discount_amt", "payment_method"
    )


@register("c04_parse_sale_date", q("SELECT order_id, TRY_CAST(CAST(sale_date AS VARCHAR) AS DATE) AS sale_date FROM raw_sales"))
def c04(spark, sf):
    r = raw(spark, sf)
    return r.select("order_id", F.try_to_date(F.col("sale_date").cast("string"), "yyyy-MM-dd").alias("sale_date"))


@register("c05_date_window", q("SELECT order_id, sale_date FROM pre WHERE drop_reason IS NULL OR drop_reason = 'non_positive'"))
def c05(spark, sf):
    t = pre_tagged(spark, sf)
    return t.where(F.col("drop_reason").isNull() | (F.col("drop_reason") == "non_positive")).select("order_id", "sale_date")


@register("c06_positive_amount", q("SELECT order_id, total_amount FROM pre WHERE drop_reason IS NULL"), money=("total_amount",))
def c06(spark, sf):
    t = pre_tagged(spark, sf)
    return t.where(F.col("drop_reason").isNull()).select("order_id", "total_amount")


@register(
    "c07_iqr_fence",
    q(
        """SELECT round(q[1], 4) AS q1, round(q[2], 4) AS q3, round(q[2] - q[1], 4) AS iqr,
  round(q[1] - 1.5 * (q[2] - q[1]), 4) AS lower, round(q[2] + 1.5 * (q[2] - q[1]), 4) AS upper,
  (SELECT COUNT(*) FROM tagged WHERE drop_reason = 'outlier') AS outliers
  FROM (SELECT quantile_cont(CAST(total_amount AS DOUBLE), [0.25, 0.75]) AS q FROM pre WHERE drop_reason IS NULL)"""
    ),
)
def c07(spark, sf):
    f = cleaning.fences(reasons(spark, sf), params())
    n_out = tagged(spark, sf).agg(F.count_if(F.col("drop_reason") == "outlier").alias("outliers"))
    return f.select(*[F.round(c, 4).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")]).crossJoin(n_out)


@register("c07_approx_fence", q("SELECT COUNT(*) AS kept, true AS q1_near, true AS q3_near FROM pre WHERE drop_reason IS NULL"))
def c07_approx(spark, sf):
    """C7 in approximate mode: quartiles from merged sketches, within 1 % of rank."""
    x = reasons(spark, sf).where("drop_reason is null").select(F.col("total_amount").cast("double").alias("x"))
    both = x.crossJoin(F.broadcast(quantile.quartiles(x, "x", "approx")))  # one row

    def near(q_: str, p: float):
        below, upto = F.count_if(F.col("x") < F.col(q_)), F.count_if(F.col("x") <= F.col(q_))
        return (below <= (p + 0.01) * F.count("x")) & (upto >= (p - 0.01) * F.count("x"))

    return both.agg(F.count("x").alias("kept"), near("q1", 0.25).alias("q1_near"), near("q3", 0.75).alias("q3_near"))


@register("c08_text_standardise", q("SELECT order_id, category, region, order_status, payment_method, city FROM clean"))
def c08(spark, sf):
    return clean(spark, sf).select("order_id", "category", "region", "order_status", "payment_method", "city")


@register("c09_calendar_columns", q("SELECT order_id, year, month, month_name, quarter, day_of_week, is_weekend FROM clean"))
def c09(spark, sf):
    return clean(spark, sf).select("order_id", "year", "month", "month_name", "quarter", "day_of_week", "is_weekend")


@register("c10_revenue_band", q("SELECT order_id, total_amount, revenue_band FROM clean"), money=("total_amount",))
def c10(spark, sf):
    return clean(spark, sf).select("order_id", "total_amount", "revenue_band")


C11_SQL = """SELECT COUNT(*) AS original_rows,
  COUNT(*) FILTER (WHERE drop_reason = 'duplicate') AS duplicates_removed,
  COUNT(*) FILTER (WHERE drop_reason = 'null_critical') AS nulls_dropped,
  COUNT(*) FILTER (WHERE drop_reason = 'invalid_date') AS invalid_dates_removed,
  COUNT(*) FILTER (WHERE drop_reason = 'non_positive') AS negative_amounts_removed,
  COUNT(*) FILTER (WHERE drop_reason = 'outlier') AS outliers_removed,
  COUNT(*) FILTER (WHERE drop_reason IS NULL) AS final_rows,
  COUNT(*) - COUNT(*) FILTER (WHERE drop_reason IS NULL) AS rows_removed,
  round_even(CAST(COUNT(*) - COUNT(*) FILTER (WHERE drop_reason IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0, 2) AS cleaning_pct,
  round_even(100.0 - round_even(CAST(COUNT(*) - COUNT(*) FILTER (WHERE drop_reason IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0, 2), 1) AS data_quality_pct
  FROM tagged"""


@register("c11_cleaning_report", q(C11_SQL))
def c11(spark, sf):
    return cleaning.cleaning_report(tagged(spark, sf))


def _profile_sql() -> str:
    money = ["unit_price", "discount_pct", "discount_amt", "total_amount"]
    ints = ["quantity", "year", "month", "quarter", "is_weekend"]
    types = {"unit_price": "decimal(12,2)", "discount_pct": "decimal(5,2)", "discount_amt": "decimal(12,2)", "total_amount": "decimal(12,2)",
             "quantity": "int", "year": "int", "month": "int", "quarter": "int", "is_weekend": "boolean"}
    parts = []
    for c in money + ints:
        v = f"CAST({c} AS INTEGER)" if c == "is_weekend" else c
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(MIN({v}) AS DOUBLE) AS min_value, CAST(MAX({v}) AS DOUBLE) AS max_value, "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, '{types[c]}' AS dtype FROM clean"
        )
    return q(" UNION ALL ".join(parts))


@register("c12_numeric_profile", _profile_sql())
def c12(spark, sf):
    return cleaning.numeric_profile(clean(spark, sf))


# ---------------------------------------------------------------------------
# V: quality checks (on the cleaned table, as the reference validates it)
# ---------------------------------------------------------------------------
def _checks_sql(source: str) -> str:
    cats = ", ".join(f"'{c}'" for c in params().allowed_categories)
    rows = [f"SELECT 'No nulls in ''{c}''' AS \"check\", COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {source}" for c in quality.CRITICAL]
    rows.append(f"SELECT 'No duplicate order_ids', COALESCE(SUM(n - 1), 0) FROM (SELECT order_id, COUNT(*) AS n FROM {source} GROUP BY order_id)")
    rows.append(f"SELECT 'All amounts > 0', COUNT(*) FILTER (WHERE total_amount <= 0) FROM {source}")
    rows.append(f"SELECT 'No future sale dates', COUNT(*) FILTER (WHERE sale_date > DATE '{params().as_of.isoformat()}') FROM {source}")
    rows.append(f"SELECT 'Valid category values', COUNT(*) FILTER (WHERE NOT COALESCE(category IN ({cats}), false)) FROM {source}")
    rows.append(f"SELECT 'Row count >= {params().min_rows:,}', GREATEST({params().min_rows} - COUNT(*), 0) FROM {source}")
    union = " UNION ALL ".join(rows)
    return f"""chk_raw AS ({union}),
chk AS (SELECT "check", CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM chk_raw)"""


@register("v01_null_checks", q("SELECT * FROM chk WHERE \"check\" LIKE 'No nulls%'", _checks_sql("clean")))
def v01(spark, sf):
    return quality.checks(clean(spark, sf), params()).where(F.col("check").startswith("No nulls"))


@register("v02_duplicate_ids", q("SELECT * FROM chk WHERE \"check\" = 'No duplicate order_ids'", _checks_sql("clean")))
def v02(spark, sf):
    return quality.checks(clean(spark, sf), params()).where(F.col("check") == "No duplicate order_ids")


@register("v03_non_positive_amounts", q("SELECT * FROM chk WHERE \"check\" = 'All amounts > 0'", _checks_sql("clean")))
def v03(spark, sf):
    return quality.checks(clean(spark, sf), params()).where(F.col("check") == "All amounts > 0")


@register("v04_future_dates", q("SELECT * FROM chk WHERE \"check\" = 'No future sale dates'", _checks_sql("clean")))
def v04(spark, sf):
    return quality.checks(clean(spark, sf), params()).where(F.col("check") == "No future sale dates")


@register("v05_category_domain", q("SELECT * FROM chk WHERE \"check\" = 'Valid category values'", _checks_sql("clean")))
def v05(spark, sf):
    return quality.checks(clean(spark, sf), params()).where(F.col("check") == "Valid category values")


@register("v06_min_rows", q("SELECT * FROM chk WHERE \"check\" LIKE 'Row count%'", _checks_sql("clean")))
def v06(spark, sf):
    return quality.checks(clean(spark, sf), params()).where(F.col("check").startswith("Row count"))


_SCORE_SQL = """SELECT COUNT(*) FILTER (WHERE passed) AS passed_checks, COUNT(*) AS total_checks,
  round_even(CAST(COUNT(*) FILTER (WHERE passed) AS DOUBLE) / COUNT(*) * 100.0, 1) AS score,
  CASE WHEN round_even(CAST(COUNT(*) FILTER (WHERE passed) AS DOUBLE) / COUNT(*) * 100.0, 1) >= 90 THEN 'EXCELLENT'
       WHEN round_even(CAST(COUNT(*) FILTER (WHERE passed) AS DOUBLE) / COUNT(*) * 100.0, 1) >= 75 THEN 'ACCEPTABLE'
       ELSE 'POOR' END AS band FROM chk"""


@register("v07_quality_score", q(_SCORE_SQL, _checks_sql("clean")))
def v07(spark, sf):
    return quality.score(quality.checks(clean(spark, sf), params()))


@register("v07_quality_score_raw_feed", q(_SCORE_SQL, _checks_sql("raw_sales")))
def v07_raw(spark, sf):
    """The same validator applied to the raw feed (duplicates and future dates fail)."""
    return quality.score(quality.checks(raw(spark, sf), params()))


# ---------------------------------------------------------------------------
# C and V on the feed with faults, where every rule fires
# ---------------------------------------------------------------------------
def dq(select: str, ctes: str = "") -> str:
    return q(select, ctes, O.DIRTY_PREFIX)


@register("c02_dirty_feed", dq("SELECT drop_reason, order_id, total_amount, sale_date FROM pre WHERE drop_reason IN ('null_critical', 'non_positive')"), money=("total_amount",))
def c02_dirty(spark, sf):
    """The rows that they reject."""
    t = pre_tagged(spark, sf, dirty=True)
    return t.where(F.col("drop_reason").isin("null_critical", "non_positive")).select("drop_reason", "order_id", "total_amount", "sale_date")


@register(
    "c03_dirty_feed",
    dq(
        f"""SELECT order_id, COALESCE(customer_email, '{S.FILL_EMAIL}') AS customer_email, COALESCE(discount_pct, CAST(0 AS DECIMAL(5,2))) AS discount_pct,
  COALESCE(payment_method, '{S.FILL_PAYMENT}') AS payment_method FROM pre WHERE drop_reason IS NULL"""
    ),
    money=("discount_pct",),
)
def c03_dirty(spark, sf):
    """All kept rows, so that a fill of another row shows too."""
    return pre_tagged(spark, sf, dirty=True).where("drop_reason is null").select("order_id", "customer_email", "discount_pct", "payment_method")


@register("c04_dirty_feed", dq("SELECT load_seq, order_id, sale_date, quantity, total_amount FROM raw_sales"), money=("total_amount",))
def c04_dirty(spark, sf):
    """Dates, quantities and amounts out of text, unparsable ones NULL."""
    return dirty_raw(spark, sf).select("load_seq", "order_id", "sale_date", "quantity", "total_amount")


@register("c07_dirty_feed", dq("SELECT order_id, total_amount FROM tagged WHERE drop_reason = 'outlier'"), money=("total_amount",))
def c07_dirty(spark, sf):
    """The outliers."""
    return tagged(spark, sf, dirty=True).where("drop_reason = 'outlier'").select("order_id", "total_amount")


@register("c08_dirty_feed", dq("SELECT order_id, category, region, order_status, payment_method, city FROM clean"))
def c08_dirty(spark, sf):
    """Categories with white space of other scripts around them, NULL ones."""
    return clean(spark, sf, dirty=True).select("order_id", "category", "region", "order_status", "payment_method", "city")


@register("c11_dirty_feed", dq(C11_SQL))
def c11_dirty(spark, sf):
    return cleaning.cleaning_report(tagged(spark, sf, dirty=True))


@register("v01_v06_dirty_feed", dq("SELECT * FROM chk", _checks_sql("raw_sales")))
def v_dirty(spark, sf):
    """V1-V6 on the uncleaned feed: all but the row count have violations."""
    return quality.checks(dirty_raw(spark, sf), params())


@register("v01_v06_dirty_cleaned", dq("SELECT * FROM chk", _checks_sql("clean")))
def v_dirty_cleaned(spark, sf):
    """V1-V6 after cleaning: NULL categories and regions remain."""
    return quality.checks(clean(spark, sf, dirty=True), params())


# ---------------------------------------------------------------------------
# K: KPIs
# ---------------------------------------------------------------------------
@register("k01_total_revenue", q("SELECT total_revenue FROM h", HEADLINE))
def k01(spark, sf):
    return _sel(kpis.headline(rolled(spark, sf)), "total_revenue")


@register("k02_total_orders", q("SELECT total_orders FROM h", HEADLINE))
def k02(spark, sf):
    return _sel(kpis.headline(rolled(spark, sf)), "total_orders")


@register("k03_total_customers", q("SELECT total_customers FROM h", HEADLINE))
def k03(spark, sf):
    return kpis.customers(clean(spark, sf))


@register("k03_approx_customers", q("SELECT total_customers, true AS within_bound FROM h", HEADLINE))
def k03_approx(spark, sf):
    """K3 from monthly sketches that are written and merged: within 3 % (3.7 standard errors) of the exact count."""
    sketches = files.scratch_table(rollup.customer_sketches(clean(spark, sf)), "customer_sketches")
    near = rollup.approx_customers(sketches).withColumnRenamed("total_customers", "approx")
    close = F.abs(F.col("approx") - F.col("total_customers")) <= 0.03 * F.col("total_customers")
    return kpis.customers(clean(spark, sf)).crossJoin(near).select("total_customers", close.alias("within_bound"))


@register("k04_avg_order_value", q("SELECT avg_order_value FROM h", HEADLINE))
def k04(spark, sf):
    return _sel(kpis.headline(rolled(spark, sf)), "avg_order_value")


@register("k05_monthly_revenue", q("SELECT year, month, round_even(revenue, 2) AS revenue FROM m", MONTHLY))
def k05(spark, sf):
    return kpis.monthly(rolled(spark, sf))


@register("k06_mom_growth", q("SELECT mom_growth_pct, this_month_rev, last_month_rev FROM g", MOM))
def k06(spark, sf):
    return _sel(kpis.mom_growth(rolled(spark, sf)), "mom_growth_pct", "this_month_rev", "last_month_rev")


@register("k07_return_rate", q("SELECT return_rate_pct FROM h", HEADLINE))
def k07(spark, sf):
    return _sel(kpis.headline(rolled(spark, sf)), "return_rate_pct")


@register(
    "k08_top_performers",
    q(f"SELECT * FROM {top_sql('category', 'top_category')} CROSS JOIN {top_sql('region', 'top_region')} CROSS JOIN {top_sql('product_name', 'top_product')}"),
)
def k08(spark, sf):
    return kpis.top_performers(rolled(spark, sf), clean(spark, sf))


@register("k09_discounts", q("SELECT avg_discount_pct, total_discount FROM h", HEADLINE))
def k09(spark, sf):
    return _sel(kpis.headline(rolled(spark, sf)), "avg_discount_pct", "total_discount")


@register(
    "k10_category_revenue",
    q("SELECT category, round_even(CAST(SUM(total_amount) AS DOUBLE), 2) AS revenue FROM delivered WHERE category IS NOT NULL GROUP BY category"),
)
def k10(spark, sf):
    return kpis.category_revenue(rolled(spark, sf))


@register("k11_monthly_trend_records", q("SELECT year, month, round_even(revenue, 2) AS revenue FROM m", MONTHLY))
def k11(spark, sf):
    return kpis.monthly(rolled(spark, sf))


@register(
    "k12_kpi_summary",
    q(
        f"""SELECT h.total_revenue, h.total_orders, h.total_customers, h.avg_order_value, h.return_rate_pct,
  h.avg_discount_pct, h.total_discount, g.mom_growth_pct, g.this_month_rev, g.last_month_rev, t.*
  FROM h CROSS JOIN g CROSS JOIN (SELECT * FROM {top_sql('category', 'top_category')} CROSS JOIN {top_sql('region', 'top_region')}
  CROSS JOIN {top_sql('product_name', 'top_product')}) t""",
        HEADLINE + "," + MOM,
    ),
)
def k12(spark, sf):
    return kpis.kpi_summary(rolled(spark, sf), clean(spark, sf))


# ---------------------------------------------------------------------------
# TR: trends
# ---------------------------------------------------------------------------
TR1_SQL = f"""SELECT year, month, month_name, round_even(CAST(SUM(total_amount) AS DOUBLE), 2) AS revenue,
  COUNT(order_id) AS orders, round_even({O.mean('total_amount')}, 2) AS avg_val
  FROM delivered WHERE year IS NOT NULL AND month IS NOT NULL AND month_name IS NOT NULL GROUP BY year, month, month_name"""
TR2_CTE = f"""tr1 AS ({TR1_SQL}),
tr2 AS (SELECT *, round_even((revenue / lag(revenue) OVER (ORDER BY year, month) - 1.0) * 100.0, 2) AS mom_growth_pct FROM tr1)"""


@register("tr01_monthly_trend", q(TR1_SQL))
def tr01(spark, sf):
    return trends.monthly_trend(rolled(spark, sf)).drop("mom_growth_pct")


@register("tr02_monthly_mom_growth", q("SELECT * FROM tr2", TR2_CTE))
def tr02(spark, sf):
    return trends.monthly_trend(rolled(spark, sf))


@register(
    "tr03_category_trend",
    q("""SELECT year, month, category, round_even(CAST(SUM(total_amount) AS DOUBLE), 2) AS revenue FROM delivered
  WHERE year IS NOT NULL AND month IS NOT NULL AND category IS NOT NULL GROUP BY year, month, category"""),
)
def tr03(spark, sf):
    return trends.category_trend(rolled(spark, sf))


@register(
    "tr04_region_trend",
    q(f"""SELECT region, round_even(CAST(SUM(total_amount) AS DOUBLE), 2) AS revenue, COUNT(order_id) AS orders,
  round_even({O.mean('total_amount')}, 2) AS avg_val FROM delivered WHERE region IS NOT NULL GROUP BY region"""),
)
def tr04(spark, sf):
    return trends.region_trend(rolled(spark, sf))


WEEKEND_SQL = """SELECT is_weekend, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(order_id) AS orders,
  CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS label FROM delivered WHERE is_weekend IS NOT NULL GROUP BY is_weekend"""


@register("tr05_weekend_vs_weekday", q(WEEKEND_SQL))
def tr05(spark, sf):
    return trends.weekend_vs_weekday(rolled(spark, sf))


@register(
    "tr06_category_share",
    q("""SELECT category, CAST(rev AS DOUBLE) AS revenue,
  round_even(CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE) * 100.0, 1) AS share_pct
  FROM (SELECT category, SUM(total_amount) AS rev FROM delivered
  WHERE year IS NOT NULL AND month IS NOT NULL AND category IS NOT NULL GROUP BY category)"""),
)
def tr06(spark, sf):
    return trends.category_share(rolled(spark, sf))


@register(
    "tr07_last_six_months",
    q("SELECT year, month, month_name, revenue, mom_growth_pct FROM tr2 ORDER BY year DESC, month DESC LIMIT 6", TR2_CTE),
)
def tr07(spark, sf):
    return trends.last_months(rolled(spark, sf), 6)


# ---------------------------------------------------------------------------
# I: impact scores
# ---------------------------------------------------------------------------
@register("i01_normalize_scores", q("SELECT category, rev_score, growth_score, vol_score FROM cgr", CAT_SCORE))
def i01(spark, sf):
    return _sel(impact.score_categories(rolled(spark, sf)), "category", "rev_score", "growth_score", "vol_score")


@register("i02_category_growth", q("SELECT category, growth_pct FROM cg", CAT_GROWTH))
def i02(spark, sf):
    return impact.category_growth(rolled(spark, sf))


@register("i03_category_aggregate", q("SELECT category, revenue, orders, growth_pct FROM cgr", CAT_SCORE))
def i03(spark, sf):
    return _sel(impact.score_categories(rolled(spark, sf)), "category", "revenue", "orders", "growth_pct")


@register("i04_category_score", q("SELECT category, impact_score FROM cgr", CAT_SCORE))
def i04(spark, sf):
    return _sel(impact.score_categories(rolled(spark, sf)), "category", "impact_score")


@register("i05_category_grade", q("SELECT category, revenue, growth_pct, impact_score, grade FROM cgr", CAT_SCORE))
def i05(spark, sf):
    return _sel(impact.score_categories(rolled(spark, sf)), "category", "revenue", "growth_pct", "impact_score", "grade")


@register("i06_region_score", q("SELECT * FROM rs", REG_SCORE))
def i06(spark, sf):
    return impact.score_regions(rolled(spark, sf))


# ---------------------------------------------------------------------------
# H: customers and churn
# ---------------------------------------------------------------------------
@register(
    "h01_customer_aggregates",
    q("SELECT customer_email, total_orders, total_spent, avg_order_value, last_order_date, first_order_date, avg_discount FROM cfe", CUST),
)
def h01(spark, sf):
    return _sel(
        customers.customer_features(clean(spark, sf)),
        "customer_email", "total_orders", "total_spent", "avg_order_value", "last_order_date", "first_order_date", "avg_discount",
    )


@register(
    "h02_favourites",
    q("SELECT cu.customer_email, fc.fav_category, fr.fav_region FROM cu LEFT JOIN fc USING (customer_email) LEFT JOIN fr USING (customer_email)", CUST + "," + FAVS),
)
def h02(spark, sf):
    return _sel(customers.customer_features(clean(spark, sf)), "customer_email", "fav_category", "fav_region")


@register("h03_days_since_last", q("SELECT customer_email, last_order_date, days_since_last FROM cfe", CUST))
def h03(spark, sf):
    return _sel(customers.customer_features(clean(spark, sf)), "customer_email", "last_order_date", "days_since_last")


@register("h04_customer_lifetime", q("SELECT customer_email, customer_lifetime FROM cfe", CUST))
def h04(spark, sf):
    return _sel(customers.customer_features(clean(spark, sf)), "customer_email", "customer_lifetime")


@register("h05_order_frequency", q("SELECT customer_email, order_frequency FROM cfe", CUST))
def h05(spark, sf):
    return _sel(customers.customer_features(clean(spark, sf)), "customer_email", "order_frequency")


@register("h06_churn_label", q("SELECT customer_email, days_since_last, churned FROM cfe", CUST))
def h06(spark, sf):
    return _sel(customers.customer_features(clean(spark, sf)), "customer_email", "days_since_last", "churned")


@register(
    "h06_churn_summary",
    q("SELECT COUNT(*) AS customers, CAST(SUM(churned) AS BIGINT) AS churned, round_even(AVG(churned) * 100.0, 1) AS churn_rate_pct FROM cfe", CUST),
)
def h06s(spark, sf):
    return customers.churn_summary(customers.customer_features(clean(spark, sf)))


_FEATURES: dict = {}
_CHURN_CACHE: dict = {}


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """Customer features written once per (session, input), for the split, the fit and the scoring."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FEATURES:
        _FEATURES[key] = files.scratch_table(customers.customer_features(clean(spark, sf)), "customer_features")
    return _FEATURES[key]


def _churn(spark, sf):
    """Train once per (session, input) and reuse for H7-H14 and S9."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CHURN_CACHE:
        feats = _features(spark, sf)
        cm, test = churn_model.train(feats)
        scored = churn_model.score(cm, feats)
        _CHURN_CACHE[key] = (cm, test, scored, feats)
    return _CHURN_CACHE[key]


@register(
    "h07_favourite_encoding",
    q(
        """SELECT cu.customer_email, fc.fav_category,
  CAST(dense_rank() OVER (ORDER BY fc.fav_category) - 1 AS DOUBLE) AS fav_category_enc
  FROM cu JOIN fc USING (customer_email)""",
        CUST + "," + FAVS,
    ),
)
def h07(spark, sf):
    cm, _, _, feats = _churn(spark, sf)
    return cm.model.stages[0].transform(feats).select("customer_email", "fav_category", F.col("fav_category_index").alias("fav_category_enc"))


SPLIT = f"""kc AS (SELECT churned, COUNT(*) AS k, SUM(COUNT(*)) OVER () AS n FROM cfe GROUP BY churned),
ks AS (SELECT *, n - CAST(ceil({1 - churn_model.TRAIN_FRACTION!r}::DOUBLE * n) AS BIGINT) AS n_train FROM kc),
kf AS (SELECT *, CAST(floor(k * n_train / n::DOUBLE) AS BIGINT) AS base, k * n_train / n::DOUBLE AS exact FROM ks),
kt AS (SELECT churned, k, n_train,
  base + CAST(row_number() OVER (ORDER BY base - exact, churned) <= n_train - SUM(base) OVER () AS BIGINT) AS size FROM kf)"""


@register(
    "h08_stratified_split",
    q(
        """SELECT * FROM (SELECT churned, TRUE AS is_train, size AS customers FROM kt
  UNION ALL SELECT churned, FALSE, k - size FROM kt) WHERE customers > 0""",
        CUST + "," + SPLIT,
    ),
)
def h08(spark, sf):
    return churn_model.split(_features(spark, sf)).groupBy("churned", "is_train").agg(F.count(F.lit(1)).alias("customers"))


@register(
    "h09_class_weights",
    q("SELECT churned, size AS train_rows, n_train / (2.0::DOUBLE * size) AS weight FROM kt WHERE size > 0", CUST + "," + SPLIT),
)
def h09(spark, sf):
    weighted = churn_model.with_class_weights(churn_model.split(_features(spark, sf)).where("is_train"))
    return weighted.groupBy("churned").agg(F.count(F.lit(1)).alias("train_rows"), F.max("w").alias("weight"))


@register("h10_model_metrics")
def h10(spark, sf):
    cm, test, _, _ = _churn(spark, sf)
    return churn_model.evaluate(cm, test, spark)


@register("h11_feature_importance")
def h11(spark, sf):
    return churn_model.feature_importance(_churn(spark, sf)[0], spark)


@register("h12_churn_probability")
def h12(spark, sf):
    return _sel(_churn(spark, sf)[2], "customer_email", "churn_probability")


@register("h13_risk_levels")
def h13(spark, sf):
    return _churn(spark, sf)[2]


@register("h14_top_high_risk")
def h14(spark, sf):
    return churn_model.top_risk(_churn(spark, sf)[2])


@register("h15_report_churn", q("SELECT total_customers, churned_customers, churn_rate_pct FROM rcx", REPORT_CHURN))
def h15(spark, sf):
    return _sel(customers.report_churn(clean(spark, sf)), "total_customers", "churned_customers", "churn_rate_pct")


@register("h16_revenue_at_risk", q("SELECT churned_customers, mean_delivered_amount, revenue_at_risk FROM rcx", REPORT_CHURN))
def h16(spark, sf):
    return _sel(customers.report_churn(clean(spark, sf)), "churned_customers", "mean_delivered_amount", "revenue_at_risk")


# ---------------------------------------------------------------------------
# F: forecast and projection
# ---------------------------------------------------------------------------
@register(
    "f01_daily_revenue",
    q("SELECT sale_date AS ds, CAST(SUM(total_amount) AS DOUBLE) AS y FROM delivered WHERE sale_date IS NOT NULL GROUP BY sale_date"),
)
def f01(spark, sf):
    return projection.daily_revenue(rolled(spark, sf))


@register("f02_revenue_forecast")
def f02(spark, sf):
    return forecast.forecast(rolled(spark, sf), S.FORECAST_DAYS)


def _future_sql(series: str, key: str = "") -> str:
    """Days of each series (key, ds, y) and the days after its last one."""
    lead = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""SELECT {lead}ds, false AS is_future FROM {series}
  UNION ALL SELECT {lead}CAST(d AS DATE), true FROM (SELECT {lead}MAX(ds) AS mx FROM {series} {group}),
  LATERAL (SELECT unnest(generate_series(CAST(mx + 1 AS TIMESTAMP), CAST(mx + {S.FORECAST_DAYS} AS TIMESTAMP), INTERVAL 1 DAY)) AS d)"""


DAILY = "dy AS (SELECT sale_date AS ds, CAST(SUM(total_amount) AS DOUBLE) AS y FROM delivered WHERE sale_date IS NOT NULL GROUP BY sale_date)"
DAILY_BY_CATEGORY = """dc AS (SELECT category AS series, sale_date AS ds, CAST(SUM(total_amount) AS DOUBLE) AS y
  FROM delivered WHERE sale_date IS NOT NULL AND category IS NOT NULL GROUP BY category, sale_date)"""


@register("f03_future_dates", q(_future_sql("dy"), DAILY))
def f03(spark, sf):
    return projection.prediction_dates(projection.daily_revenue(rolled(spark, sf)), S.FORECAST_DAYS)


@register(
    "f03_category_frame",
    q(f"SELECT f.*, dc.y FROM ({_future_sql('dc', 'series')}) f LEFT JOIN dc ON f.series = dc.series AND f.ds = dc.ds AND NOT f.is_future", DAILY_BY_CATEGORY),
)
def f03_categories(spark, sf):
    """F3 per category, out of the grouped fits: days, kind and actual value of every predicted row."""
    return forecast.prediction(rolled(spark, sf), S.FORECAST_DAYS, by="category").select("series", "ds", "is_future", "y")


@register("f02_category_forecast")
def f02_categories(spark, sf):
    """F2 per category: fitted and future values with their band."""
    return forecast.prediction(rolled(spark, sf), S.FORECAST_DAYS, by="category")


@register("f04_future_rows")
def f04(spark, sf):
    return forecast.forecast(rolled(spark, sf), S.FORECAST_DAYS).select("ds", "yhat", "yhat_lower", "yhat_upper")


@register("f05_forecast_summary")
def f05(spark, sf):
    return forecast.forecast_summary(forecast.forecast(rolled(spark, sf), S.FORECAST_DAYS))


@register("f06_tail_baseline", q("SELECT round_even(last_3_avg, 2) AS last_3_avg, round_even(last_month, 2) AS last_month FROM tg", TAIL))
def f06(spark, sf):
    return _sel(projection.revenue_projection(rolled(spark, sf)), "last_3_avg", "last_month")


@register("f07_growth_rate", q("SELECT round_even(growth, 6) AS growth FROM tg", TAIL))
def f07(spark, sf):
    return _sel(projection.revenue_projection(rolled(spark, sf)), "growth")


@register(
    "f08_next_projection",
    q(
        """SELECT round_even(last_month * (1 + growth), 2) AS forecast_next_month,
  round_even(last_month * (1 + growth) + last_month * pow(1 + growth, 2) + last_month * pow(1 + growth, 3), 2) AS forecast_next_quarter FROM tg""",
        TAIL,
    ),
)
def f08(spark, sf):
    return _sel(projection.revenue_projection(rolled(spark, sf)), "forecast_next_month", "forecast_next_quarter")


@register(
    "f09_category_projection",
    q(
        """SELECT category, round_even(last_month_rev, 2) AS last_month_rev, round_even(growth, 6) AS growth,
  round_even(last_month_rev * (1 + growth), 2) AS projected_rev FROM (
  SELECT cp.*, CASE WHEN cp.n_months >= 2 THEN COALESCE(CASE WHEN mean_chg <> 0 THEN mean_chg END, tg.growth) ELSE tg.growth END AS growth
  FROM cp CROSS JOIN tg)""",
        TAIL
        + """,
cm2 AS (SELECT category, year, month, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM delivered
  WHERE category IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL GROUP BY 1, 2, 3),
cc AS (SELECT *, revenue / lag(revenue) OVER (PARTITION BY category ORDER BY year, month) - 1.0 AS chg,
  row_number() OVER (PARTITION BY category ORDER BY year DESC, month DESC) AS rk FROM cm2),
cp AS (SELECT category, COUNT(*) AS n_months, MAX(CASE WHEN rk = 1 THEN revenue END) AS last_month_rev, AVG(chg) AS mean_chg
  FROM cc GROUP BY category)""",
    ),
)
def f09(spark, sf):
    return projection.category_projection(rolled(spark, sf))


@register("f10_persist_forecast")
def f10(spark, sf):
    path = scratch_path(spark, f"sales_forecast_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    files.write_table(forecast.forecast(rolled(spark, sf), S.FORECAST_DAYS), path)
    return files.read_table(spark, path)


# ---------------------------------------------------------------------------
# R: report datasets
# ---------------------------------------------------------------------------
@register(
    "r01_mis_summary",
    q(
        """SELECT 1 AS row_no, 'Total Revenue' AS metric, h.total_revenue AS value, CAST(NULL AS VARCHAR) AS text_value, g.mom_growth_pct AS change_pct FROM h, g
  UNION ALL SELECT 2, 'Total Orders', CAST(h.total_orders AS DOUBLE), NULL, NULL FROM h
  UNION ALL SELECT 3, 'Avg Order Value', COALESCE(h.avg_order_value, 0.0), NULL, NULL FROM h
  UNION ALL SELECT 4, 'Return Rate', h.return_rate_pct, NULL, NULL FROM h
  UNION ALL SELECT 5, 'Top Category', NULL, top_category, NULL FROM tops
  UNION ALL SELECT 6, 'Top Region', NULL, top_region, NULL FROM tops""",
        HEADLINE + "," + MOM + "," + TOPS,
    ),
)
def r01(spark, sf):
    return reports.mis_summary(rolled(spark, sf))


@register("r02_mis_monthly", q("SELECT year, month, month_name, revenue, orders FROM tr1", f"tr1 AS ({TR1_SQL})"))
def r02(spark, sf):
    return reports.mis_monthly(rolled(spark, sf))


@register(
    "r03_mis_categories",
    q("SELECT category, CAST(rev_dec AS DOUBLE) AS revenue, orders, round_even(CAST(rev_dec AS DOUBLE) / CAST(total AS DOUBLE) * 100.0, 2) AS share_pct FROM ctt", CAT_TABLE),
)
def r03(spark, sf):
    return reports.mis_categories(rolled(spark, sf))


@register(
    "r04_mis_data",
    q(
        "SELECT " + ", ".join(reports.MIS_DATA_COLUMNS)
        + f" FROM delivered ORDER BY loaded_at, load_seq, order_id LIMIT {S.MIS_DATA_ROWS}"
    ),
    money=("total_amount",),
)
def r04(spark, sf):
    return reports.mis_data(clean(spark, sf))


IMPACT_SQL = HEADLINE + "," + MOM + "," + TOPS + """,
dm AS (SELECT CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS total_orders FROM delivered),
im AS (SELECT COALESCE(dm.total_revenue, 0.0) AS total_revenue, dm.total_orders,
  COALESCE(dm.total_revenue / CAST(dm.total_orders AS DOUBLE), 0.0) AS avg_order_value, h.return_rate_pct, g.mom_growth_pct,
  g.this_month_raw AS this_month_rev, g.last_month_raw AS last_month_rev, tops.top_category, tops.top_region,
  g.mom_growth_pct >= 0 AS growth_good, h.return_rate_pct < 15 AS return_rate_good
  FROM dm CROSS JOIN h CROSS JOIN g CROSS JOIN tops)"""


@register(
    "r05_impact_metrics",
    q("SELECT total_revenue, total_orders, avg_order_value, return_rate_pct, mom_growth_pct, this_month_rev, last_month_rev, top_category, top_region FROM im", IMPACT_SQL),
)
def r05(spark, sf):
    return reports.impact_metrics(rolled(spark, sf)).drop("growth_good", "return_rate_good")


@register(
    "r06_impact_categories",
    q("SELECT category, CAST(rev_dec AS DOUBLE) AS revenue, round_even(CAST(rev_dec AS DOUBLE) / CAST(total AS DOUBLE) * 100.0, 1) AS share_pct FROM ctt", CAT_TABLE),
)
def r06(spark, sf):
    return reports.impact_categories(rolled(spark, sf))


@register("r07_good_bad_flags", q("SELECT mom_growth_pct, return_rate_pct, growth_good, return_rate_good FROM im", IMPACT_SQL))
def r07(spark, sf):
    return _sel(reports.impact_metrics(rolled(spark, sf)), "mom_growth_pct", "return_rate_pct", "growth_good", "return_rate_good")


@register("r08_coach_metrics", q("SELECT * FROM cm", COACH))
def r08(spark, sf):
    return reports.coach_metrics(rolled(spark, sf))


@register(
    "r09_best_worst",
    q(
        f"SELECT * FROM {top_sql('category', 'top_category')} CROSS JOIN {top_sql('category', 'low_category', False)} "
        f"CROSS JOIN {top_sql('region', 'top_region')} CROSS JOIN {top_sql('region', 'low_region', False)}"
    ),
)
def r09(spark, sf):
    return reports.best_worst(rolled(spark, sf))


@register("r10_weekend_revenue", q(WEEKEND_SQL))
def r10(spark, sf):
    return reports.weekend_revenue(rolled(spark, sf))


CARDS_SQL = COACH + "," + REPORT_CHURN + f""",
bw AS (SELECT * FROM {top_sql('category', 'top_category')} CROSS JOIN {top_sql('category', 'low_category', False)}),
cards AS (
  SELECT 1 AS card_no, 'revenue' AS topic, 'MoM growth' AS subject, growth AS metric,
    CASE WHEN growth < 0 THEN 'HIGH' ELSE 'LOW' END AS priority, CAST(NULL AS DOUBLE) AS savings_estimate FROM cm
  UNION ALL SELECT 2, 'discount', 'Average discount', avg_discount_pct,
    CASE WHEN avg_discount_pct > 20 THEN 'HIGH' WHEN avg_discount_pct > 10 THEN 'MEDIUM' ELSE 'LOW' END, total_disc * CAST(0.05 AS DOUBLE) FROM cm
  UNION ALL SELECT 3, 'churn', 'Customer churn rate', churn_rate_pct,
    CASE WHEN churn_rate_pct > 30 THEN 'HIGH' WHEN churn_rate_pct > 15 THEN 'MEDIUM' ELSE 'LOW' END,
    churned_customers * CAST(0.25 AS DOUBLE) * COALESCE(cm.mean_delivered_amount, 0.0) FROM cm CROSS JOIN rcx
  UNION ALL SELECT 4, 'category_top', top_category, NULL, 'LOW', NULL FROM bw
  UNION ALL SELECT 5, 'category_low', low_category, NULL, 'MEDIUM', NULL FROM bw
  UNION ALL SELECT 6, 'returns', 'Return rate', return_rate_pct,
    CASE WHEN return_rate_pct > 15 THEN 'HIGH' WHEN return_rate_pct > 10 THEN 'MEDIUM' ELSE 'LOW' END,
    returned_orders * CAST(0.03 AS DOUBLE) * COALESCE(mean_delivered_amount, 0.0) FROM cm)"""


@register("r11_coach_cards", q("SELECT card_no, topic, subject, metric, priority FROM cards", CARDS_SQL))
def r11(spark, sf):
    return reports.coach_cards(rolled(spark, sf), single=clean(spark, sf)).drop("savings_estimate")


@register("r12_savings_estimates", q("SELECT card_no, topic, savings_estimate FROM cards", CARDS_SQL))
def r12(spark, sf):
    return _sel(reports.coach_cards(rolled(spark, sf), single=clean(spark, sf)), "card_no", "topic", "savings_estimate")


@register(
    "r13_churn_alert",
    q("SELECT total_customers, churned_customers, churn_rate_pct, mean_delivered_amount, revenue_at_risk, churn_rate_pct > 20 AS churn_alert FROM rcx", REPORT_CHURN),
)
def r13(spark, sf):
    return reports.churn_alert(clean(spark, sf))


# ---------------------------------------------------------------------------
# J: batch job
# ---------------------------------------------------------------------------
J01_SQL = f"""SELECT 'load' AS step, 'ok' AS status, (SELECT COUNT(*) FROM raw_sales) AS "rows"
  UNION ALL SELECT 'clean', 'ok', (SELECT COUNT(*) FROM clean)
  UNION ALL SELECT 'kpi', 'ok', 1
  UNION ALL SELECT 'forecast', 'ok', CASE WHEN EXISTS (SELECT 1 FROM delivered) THEN {S.FORECAST_DAYS} ELSE 0 END
  UNION ALL SELECT 'mis', 'ok', 6 + (SELECT COUNT(DISTINCT (year, month)) FROM delivered) + (SELECT COUNT(DISTINCT category) FROM delivered)
    + LEAST({S.MIS_DATA_ROWS}, (SELECT COUNT(*) FROM delivered))"""


@register("j01_batch_job_steps", q(J01_SQL))
def j01(spark, sf):
    from ledgerlens.plans import batch

    out = scratch_path(spark, f"batch_{_tag(sf)}_{uuid.uuid4().hex[:8]}")
    return batch.run(spark, sf, out).select("step", "status", "rows")
