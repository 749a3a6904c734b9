"""From raw files to gold stores for a range of months, each layer one job per table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskmart.config import CLICK_COLUMNS, REQUIRED_COLUMNS, Policy
from riskmart.operators import conform, gold, populations
from riskmart.sources import raw
from riskmart.sources.tables import read_table, write_table

SILVER = {
    "loan_daily": conform.loan_daily, "attributes": conform.attributes, "financials": conform.financials,
    "clickstream": conform.clickstream,
}


def window(policy: Policy, table: str, first=None, last=None) -> tuple[str, str]:
    """Requested months cut to those the table has data for."""
    start, end = policy.table_windows()[table]
    return str(max(start, first) if first else start), str(min(end, last) if last else end)


def bronze_and_silver(spark: SparkSession, sources: dict, root: str, policy: Policy, first=None, last=None) -> None:
    for table, path in sources.items():
        start, end = window(policy, table, first, last)
        source = raw.require_columns(raw.read_raw(spark, path), REQUIRED_COLUMNS[table], path)
        bronze = os.path.join(root, "bronze", table)
        raw.ingest(source, bronze, start, end)
        rows = raw.read_bronze(spark, bronze, start, end)
        # bronze is read by month; only deduplicated clicks are dealt otherwise
        write_table(SILVER[table](rows), os.path.join(root, "silver", table), ["snapshot_date"], rebalance=table == "clickstream", within={"snapshot_date": (start, end)})


def silver(spark: SparkSession, root: str, table: str, first=None, last=None) -> DataFrame:
    return read_table(spark, os.path.join(root, "silver", table), first, last)


def gold_stores(spark: SparkSession, root: str, policy: Policy, first=None, last=None) -> None:
    """Labels, and features of the months in the range; clickstream is read from its start, as averages go back."""
    start, end = window(policy, "label_store", first, last)
    labels = gold.labels(silver(spark, root, "loan_daily", start, end), policy.label_dpd, policy.label_mob)
    write_table(labels, os.path.join(root, "gold", "label_store"), ["snapshot_date"], rebalance=False, within={"snapshot_date": (start, end)})
    start, end = window(policy, "feature_store", first, last)
    features = gold.features(
        silver(spark, root, "loan_daily", start, end), silver(spark, root, "attributes", start, end),
        silver(spark, root, "financials", start, end), silver(spark, root, "clickstream", None, end), CLICK_COLUMNS, run_month=True,
    )
    write_table(features, os.path.join(root, "gold", "feature_store"), ["run_month"], within={"run_month": (start, end)})


def stores(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(features, labels) of all months. Features carry and are kept by ``run_month``, labels by ``snapshot_date``."""
    return tuple(read_table(spark, os.path.join(root, "gold", t)) for t in ("feature_store", "label_store"))


def run(spark: SparkSession, sources: dict, root: str, policy: Policy = Policy(), first=None, last=None) -> DataFrame:
    """Build or rebuild exactly the run months of a range; other months stay as they are. Returns the run summary."""
    bronze_and_silver(spark, sources, root, policy, first, last)
    gold_stores(spark, root, policy, first, last)
    return populations.run_summary(*stores(spark, root), policy.label_mob)

