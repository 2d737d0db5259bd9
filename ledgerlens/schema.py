"""Table schemas, fixed business values and run parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's business rules.
# ---------------------------------------------------------------------------
STATUS_DELIVERED = "Delivered"
STATUS_RETURNED = "Returned"
FILL_EMAIL = "unknown@noemail.com"
FILL_PHONE = "0000000000"
FILL_PAYMENT = "Unknown"
MIN_SALE_DATE = dt.date(2023, 1, 1)
RETAIL_CATEGORIES = ("Electronics", "Appliances", "Fashion", "Grocery", "Furniture", "Stationery", "Beauty")
MIN_ROWS = 1000
IQR_K = 1.5
REVENUE_BANDS = ((1000, "Low"), (5000, "Medium"), (20000, "High"))  # (upper bound inclusive, label)
REVENUE_BAND_TOP = "Premium"
QUALITY_BANDS = ((90, "EXCELLENT"), (75, "ACCEPTABLE"))
QUALITY_BAND_LOW = "POOR"
CATEGORY_WEIGHTS = (0.50, 0.30, 0.20)  # revenue, growth, orders
REGION_WEIGHTS = (0.60, 0.25, 0.15)  # revenue, orders, avg value
GRADES = ((75, "A"), (50, "B"), (25, "C"))
GRADE_LOW = "D"
RISK_LEVELS = ((70, "High"), (40, "Medium"))
RISK_LOW = "Low"
CHURN_DAYS = 90
DEFAULT_GROWTH = 0.02
FORECAST_DAYS = 90
MIS_DATA_ROWS = 5000
TOP_RISK_ROWS = 10
TOP_FEATURES = 5

CHURN_FEATURES = (
    "total_orders",
    "total_spent",
    "avg_order_value",
    "days_since_last",
    "customer_lifetime",
    "order_frequency",
    "avg_discount",
    "fav_category_enc",
    "fav_region_enc",
)

# Columns standardised by the text step (strip + title case).
TEXT_COLUMNS = ("category", "region", "order_status", "payment_method", "city")

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
MONEY = T.DecimalType(12, 2)
PCT = T.DecimalType(5, 2)

RAW_SALES = T.StructType(
    [
        T.StructField("load_seq", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("customer_phone", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("discount_pct", PCT),
        T.StructField("discount_amt", MONEY),
        T.StructField("total_amount", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("salesperson", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

# CSV files carry every field as text; typed coercion happens after the read.
RAW_CSV = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SALES.fields if f.name not in ("load_seq", "loaded_at")])

CLEANED_COLUMNS = (
    "order_id",
    "customer_name",
    "customer_email",
    "product_name",
    "category",
    "unit_price",
    "quantity",
    "discount_pct",
    "discount_amt",
    "total_amount",
    "payment_method",
    "region",
    "city",
    "sale_date",
    "order_status",
    "salesperson",
    "year",
    "month",
    "month_name",
    "quarter",
    "day_of_week",
    "is_weekend",
    "revenue_band",
)


@dataclass(frozen=True)
class Params:
    """Run parameters. ``as_of=None`` means the session's ``current_date()``."""

    as_of: dt.date | None = None
    min_date: dt.date = MIN_SALE_DATE
    allowed_categories: tuple[str, ...] = RETAIL_CATEGORIES
    min_rows: int = MIN_ROWS
    iqr_k: float = IQR_K
    quantile_mode: str = "exact"  # "exact" or "approx"
    churn_days: int = CHURN_DAYS
    default_growth: float = DEFAULT_GROWTH
    forecast_days: int = FORECAST_DAYS
    dedup_order: tuple[str, ...] = ("load_seq", "row_id")  # row_id where the feed has it

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
