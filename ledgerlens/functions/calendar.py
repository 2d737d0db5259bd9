"""Calendar columns derived from ``sale_date`` (cleaning step C9).

Weekday numbering is Monday=0 (``weekday``), names are the full English
month/day names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: English names, whatever the locale.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def calendar_columns(d: Column | str = "sale_date") -> dict[str, Column]:
    d = F.col(d) if isinstance(d, str) else d
    return {
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.element_at(F.array(*map(F.lit, MONTHS)), F.month(d)),
        "quarter": F.quarter(d),
        "day_of_week": F.element_at(F.array(*map(F.lit, DAYS)), F.weekday(d) + 1),
        "is_weekend": F.weekday(d) >= 5,
    }
