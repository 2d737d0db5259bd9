"""Threshold labels as CASE WHEN expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens import schema as S


def band_by_thresholds(c: Column | str, bands, otherwise: str) -> Column:
    """First band whose lower threshold is met (``c >= t``), descending thresholds."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for threshold, label in bands:
        cond = c >= F.lit(threshold)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def revenue_band(c: Column | str = "total_amount") -> Column:
    """Bins (0,1000] Low, (1000,5000] Medium, (5000,20000] High, (20000,inf) Premium.

    Outside every bin (<= 0 or NULL) gives the string 'nan', like a pandas
    ``cut`` cast to str.
    """
    c = F.col(c) if isinstance(c, str) else c
    lo = F.lit(0)
    expr = None
    for upper, label in S.REVENUE_BANDS:
        cond = (c > lo) & (c <= F.lit(upper))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
        lo = F.lit(upper)
    return expr.when(c > lo, S.REVENUE_BAND_TOP).otherwise("nan")


def grade(c: Column | str) -> Column:
    return band_by_thresholds(c, S.GRADES, S.GRADE_LOW)


def risk_level(c: Column | str) -> Column:
    return band_by_thresholds(c, S.RISK_LEVELS, S.RISK_LOW)


def quality_band(c: Column | str) -> Column:
    return band_by_thresholds(c, S.QUALITY_BANDS, S.QUALITY_BAND_LOW)
