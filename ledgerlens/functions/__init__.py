"""Column-expression helpers. All are built-in Spark expressions (codegen-friendly, no UDFs)."""

from ledgerlens.functions.calendar import calendar_columns
from ledgerlens.functions.labels import band_by_thresholds, revenue_band
from ledgerlens.functions.numeric import pct, ratio, safe_div
from ledgerlens.functions.text import standardise, strip_ws, title_case

__all__ = [
    "band_by_thresholds",
    "calendar_columns",
    "pct",
    "ratio",
    "revenue_band",
    "safe_div",
    "standardise",
    "strip_ws",
    "title_case",
]
