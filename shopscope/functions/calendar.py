"""Calendar helpers: month ordinals and labels, elapsed days.

Month arithmetic uses the ordinal year * 12 + month - 1, so "next month" is
+1 and a month difference is a subtraction (calendar months, never
day-count based month differences).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The months of the fourth quarter.
Q4_MONTHS = (10, 11, 12)


def is_q4(d: Column) -> Column:
    return F.month(d).isin(*Q4_MONTHS)


def month_ordinal(d: Column) -> Column:
    return (F.year(d) * 12 + F.month(d) - 1).cast("int")


def ordinal_label(o: Column) -> Column:
    """'yyyy-MM' label of a month ordinal."""
    return F.format_string("%04d-%02d", (o / 12).cast("int"), (o % 12 + 1).cast("int"))


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days between two timestamps (floor, not midnights crossed)."""
    return F.timestamp_diff("DAY", start, end)
