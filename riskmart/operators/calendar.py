"""Run calendar: months, table windows and the retrain schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.config import Policy
from riskmart.functions.dates import month_start, whole_months


def months_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """First days of all months from the month of ``first`` up to ``last`` (rows of bounds kept apart)."""
    return bounds.select(
        F.explode(F.sequence(month_start(F.col(first)), F.col(last), F.expr("interval 1 month"))).alias("snapshot_date")
    )


def availability(calendar: DataFrame, windows: dict) -> DataFrame:
    """(table_name, snapshot_date, available): whether a table has data in a month."""
    entries = [
        F.struct(F.lit(t).alias("table_name"), F.lit(a).alias("first"), F.lit(b).alias("last"))
        for t, (a, b) in windows.items()
    ]
    return calendar.select("snapshot_date", F.inline(F.array(*entries))).select(
        "table_name", "snapshot_date",
        F.col("snapshot_date").between(F.col("first"), F.col("last")).cast("int").alias("available"),
    )


def is_scheduled(month: Column, policy: Policy) -> Column:
    """Go-live month and every n-th month after it, to the end of the run."""
    start, end = F.lit(policy.go_live), F.lit(policy.pipeline_end)
    on_beat = F.pmod(whole_months(start, month), F.lit(policy.retrain_every_months)) == 0
    return F.coalesce(month.between(start, end) & on_beat, F.lit(False))


def outside_calendar(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Data-quality count of raw rows whose date text is no first of month and is never ingested."""
    good = F.coalesce(F.col(column).rlike(r"^\d{4}-\d{2}-01$"), F.lit(False))
    return df.agg(F.count("*").alias("n_rows"), F.count_if(~good).alias("n_outside"))
