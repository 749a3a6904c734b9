"""Month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def whole_months(start: Column, end: Column) -> Column:
    """Calendar months from start to end, days ignored."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
