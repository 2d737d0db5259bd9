"""DuckDB oracle SQL: the fixture adapter and the cleaning stage as CTEs.

Every oracle query is ``PREFIX`` + a short tail over ``raw_sales``,
``tagged`` or ``clean``. The SQL mirrors ``ledgerlens.sources.fixture`` and
``ledgerlens.operators.cleaning`` and exists only to check them.
"""

from __future__ import annotations

from ledgerlens import schema as S
from ledgerlens.sources.fixture import fixture_params

P = fixture_params()


def title_sql(expr: str) -> str:
    stripped = f"regexp_replace({expr}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
    runs = f"regexp_extract_all({stripped}, '(\\p{{L}}+|\\P{{L}}+)')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def _band_sql(c: str) -> str:
    parts = []
    lo = 0
    for upper, label in S.REVENUE_BANDS:
        parts.append(f"WHEN {c} > {lo} AND {c} <= {upper} THEN '{label}'")
        lo = upper
    parts.append(f"WHEN {c} > {lo} THEN '{S.REVENUE_BAND_TOP}'")
    return "CASE " + " ".join(parts) + " ELSE 'nan' END"


EXT = "CAST(l.l_extendedprice AS DECIMAL(12,2))"
DISC = "CAST(l.l_discount AS DECIMAL(4,2))"
DISC_AMT = f"CAST({EXT} * {DISC} AS DECIMAL(12,2))"

RAW_SALES_SQL = f"""
raw_sales AS (
  SELECT
    l.l_partkey * 1000000 + l.l_suppkey AS load_seq,
    'ORD' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
    c.c_name AS customer_name,
    CASE WHEN c.c_acctbal >= 0 THEN lower(replace(c.c_name, '#', '.')) || '@example.com' END AS customer_email,
    lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') AS customer_phone,
    p.p_name AS product_name,
    p.p_type AS category,
    CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST({DISC} * 100 AS DECIMAL(5,2)) AS discount_pct,
    {DISC_AMT} AS discount_amt,
    CAST({EXT} - {DISC_AMT} AS DECIMAL(12,2)) AS total_amount,
    o.o_orderpriority AS payment_method,
    r.r_name AS region,
    n.n_name AS city,
    CAST(o.o_orderdate AS DATE) AS sale_date,
    CASE WHEN l.l_returnflag = 'R' THEN 'RETURNED'
         WHEN l.l_linestatus = 'F' THEN 'DELIVERED'
         WHEN o.o_orderstatus = 'P' THEN 'CANCELLED'
         ELSE 'PENDING' END AS order_status,
    'Supplier#' || lpad(CAST(l.l_suppkey AS VARCHAR), 9, '0') AS salesperson,
    l.l_shipdate AS loaded_at
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

PRE_SQL = f"""
pre AS (
  SELECT *,
    CASE
      WHEN row_number() OVER (PARTITION BY order_id ORDER BY loaded_at ASC NULLS LAST, load_seq ASC NULLS LAST) > 1 THEN 'duplicate'
      WHEN total_amount IS NULL OR order_id IS NULL OR sale_date IS NULL THEN 'null_critical'
      WHEN sale_date < DATE '{P.min_date.isoformat()}' OR sale_date > DATE '{P.as_of.isoformat()}' THEN 'invalid_date'
      WHEN total_amount <= 0 THEN 'non_positive'
    END AS drop_reason
  FROM raw_sales
),
fence AS (
  SELECT q[1] - {P.iqr_k} * (q[2] - q[1]) AS lo, q[2] + {P.iqr_k} * (q[2] - q[1]) AS hi
  FROM (SELECT quantile_cont(CAST(total_amount AS DOUBLE), [0.25, 0.75]) AS q FROM pre WHERE drop_reason IS NULL)
),
tagged AS (
  SELECT pre.* REPLACE (
    COALESCE(drop_reason,
      CASE WHEN CAST(total_amount AS DOUBLE) < fence.lo OR CAST(total_amount AS DOUBLE) > fence.hi THEN 'outlier' END
    ) AS drop_reason)
  FROM pre CROSS JOIN fence
)"""

CLEAN_SQL = f"""
clean AS (
  SELECT
    order_id, customer_name,
    COALESCE(customer_email, '{S.FILL_EMAIL}') AS customer_email,
    product_name,
    {title_sql('category')} AS category,
    unit_price, quantity,
    COALESCE(discount_pct, CAST(0 AS DECIMAL(5,2))) AS discount_pct,
    COALESCE(discount_amt, CAST(0 AS DECIMAL(12,2))) AS discount_amt,
    total_amount,
    {title_sql(f"COALESCE(payment_method, '{S.FILL_PAYMENT}')")} AS payment_method,
    {title_sql('region')} AS region,
    {title_sql('city')} AS city,
    sale_date,
    {title_sql('order_status')} AS order_status,
    salesperson,
    CAST(year(sale_date) AS INTEGER) AS year,
    CAST(month(sale_date) AS INTEGER) AS month,
    strftime(sale_date, '%B') AS month_name,
    CAST(quarter(sale_date) AS INTEGER) AS quarter,
    strftime(sale_date, '%A') AS day_of_week,
    isodow(sale_date) >= 6 AS is_weekend,
    {_band_sql('total_amount')} AS revenue_band,
    loaded_at, load_seq
  FROM tagged WHERE drop_reason IS NULL
),
delivered AS (SELECT * FROM clean WHERE order_status = '{S.STATUS_DELIVERED}')"""

PREFIX = "WITH " + ",".join([RAW_SALES_SQL, PRE_SQL, CLEAN_SQL])

# The typed rows of ``fixture.dirty_feed``, under the same name, so that the cleaning CTEs apply to them.
DIRTY_SALES_SQL = f"""
raw_sales AS (
  SELECT * REPLACE (
    CASE WHEN quantity <> 49 OR discount_pct <> 10 THEN order_id END AS order_id,
    CASE WHEN order_status = 'PENDING' AND quantity % 7 = 0 THEN NULL
         WHEN quantity = 18 THEN NULL
         WHEN order_status = 'RETURNED' AND quantity % 5 = 0 THEN -total_amount
         WHEN quantity = 50 AND discount_pct = 0 THEN CAST(total_amount * 40 AS DECIMAL(12,2))
         ELSE total_amount END AS total_amount,
    CASE WHEN quantity <> 13 THEN sale_date END AS sale_date,
    CASE WHEN quantity = 12 THEN chr(160) || ' ' || chr(9) || lower(category) || chr(12288)
         WHEN quantity <> 11 THEN category END AS category,
    CASE WHEN quantity <> 19 THEN region END AS region,
    CASE WHEN quantity <> 20 THEN quantity END AS quantity,
    CASE WHEN quantity <> 16 THEN discount_pct END AS discount_pct,
    CASE WHEN quantity <> 17 THEN payment_method END AS payment_method)
  FROM feed
)"""
DIRTY_PREFIX = "WITH " + ",".join([RAW_SALES_SQL.replace("raw_sales AS", "feed AS"), DIRTY_SALES_SQL, PRE_SQL, CLEAN_SQL])

# Exact mean as both engines compute it.
def mean(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"


def q(select: str, ctes: str = "", prefix: str = PREFIX) -> str:
    """The prefix, optional extra CTEs (``name AS (...), ...``), then the final SELECT."""
    return prefix + (",\n" + ctes if ctes else "") + "\n" + select
