"""Numeric helpers.

Money stays DECIMAL(12,2) so sums are exact and independent of partition
order; values are cast to DOUBLE only for ratios and output. Rounding of
ratios is half-even (``bround``), as numpy/pandas round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num/den as DOUBLE; NULL (not inf/exception) for a zero or NULL denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(num / den, digits), half-even; NULL on a zero denominator."""
    return F.bround(safe_div(num, den), digits)


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(num / den * 100, digits), half-even; NULL on a zero denominator."""
    return F.bround(safe_div(num, den) * F.lit(100.0), digits)
