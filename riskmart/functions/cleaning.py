"""Cleaning rules as column expressions.

All casts and divisions are the ``try_`` forms: with ANSI mode on, a bad value becomes null as the
rules require, while every other error still surfaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed(c, dtype: str) -> Column:
    """Cast that gives null for unreadable text; whole numbers may be written with a fraction, which is cut off."""
    if dtype == "int":
        return F.coalesce(_col(c).try_cast("int"), _col(c).try_cast("double").try_cast("int"))
    return _col(c).try_cast(dtype)


def numeric(c, dtype: str = "float") -> Column:
    """Number behind stray underscores and blanks; text that is no number, or empty, is null.

    Goes through double so that '11.0' survives as an integer.
    """
    return F.translate(_col(c), "_", "").try_cast("double").try_cast(dtype)


def within(c, low, high) -> Column:
    """Value kept inside [low, high], else null."""
    return F.when(_col(c).between(low, high), _col(c))


def at_most(c, cap) -> Column:
    """Value kept up to a cap; null when either side is null."""
    return F.when(_col(c) <= cap, _col(c))


def not_sentinel(c, sentinel) -> Column:
    return F.when(_col(c) != sentinel, _col(c))


def one_of(c, allowed) -> Column:
    return F.when(_col(c).isin(*allowed), _col(c))


def with_letter(c) -> Column:
    """Placeholder text such as '_______' is null."""
    return F.when(_col(c).rlike("[A-Za-z]"), _col(c))


def filled(c) -> Column:
    """Trimmed text, blank to null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def matches(c, pattern: str) -> Column:
    """True where the trimmed text fits the pattern; null counts as false."""
    return F.coalesce(F.trim(_col(c)).rlike(pattern), F.lit(False))


def span_in_months(c) -> Column:
    """'10 Years and 9 Months' as 129; the year part is required."""
    def part(unit):
        return F.regexp_extract(_col(c), rf"(\d+)\s*{unit}", 1).try_cast("int")
    return F.try_add(F.try_multiply(part("Years"), F.lit(12)), F.coalesce(part("Months"), F.lit(0)))


def comma_list(c) -> Column:
    """'A, B, and C' as 'A,B,C'."""
    joined = F.regexp_replace(_col(c), r"\s*,\s*(and\s+)?", ",")
    return F.regexp_replace(joined, r"^and\s+", "")


def missed_instalments(overdue, due) -> Column:
    return F.coalesce(F.ceil(F.try_divide(_col(overdue), _col(due))).try_cast("int"), F.lit(0))


def first_missed(snapshot, missed) -> Column:
    return F.when(_col(missed) > 0, F.add_months(_col(snapshot), -_col(missed)))


def days_past_due(overdue, snapshot, first_missed_date) -> Column:
    return F.when(_col(overdue) > 0, F.datediff(_col(snapshot), _col(first_missed_date))).otherwise(F.lit(0))
