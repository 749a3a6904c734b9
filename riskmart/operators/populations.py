"""Row and column sets for training, scoring and monitoring.

Loan ids are unique, so joins on them are left to adaptive execution; only joins on customers look for hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import config as C

NOT_FEATURES = C.KEYS + ["label", "label_def", "label_date", "run_month"]


def labelled(features: DataFrame, labels: DataFrame, as_of=None) -> DataFrame:
    """Applications whose label was observed by ``as_of``; nothing dated later is read on either side."""
    known = labels.select("loan_id", "label", F.col("snapshot_date").alias("label_date"))
    if as_of is not None:
        day = F.lit(as_of).cast("date")
        known, features = known.where(F.col("label_date") <= day), features.where(F.col("snapshot_date") <= day)
    return features.join(known, ["loan_id"])


def run_summary(features: DataFrame, labels: DataFrame, mob: int = 6) -> DataFrame:
    """One row: store sizes, labels by value, matured features and labels not exactly ``mob`` months later."""
    stores = labels.agg(
        F.count("*").alias("n_labels"), F.count_if(F.col("label") == 1).alias("n_bad"),
        F.count_if(F.col("label") == 0).alias("n_good"),
    ).select("*", features.agg(F.count("*")).scalar().alias("n_features"))
    joined = labelled(features, labels)
    late = F.col("label_date") != F.add_months("snapshot_date", mob)
    matured = joined.agg(F.struct(F.count("*").alias("n"), F.count_if(late).alias("late"))).scalar()
    return stores.select(
        "*", matured.getField("n").alias("n_matured"), matured.getField("late").alias("n_misaligned"),
    )


def misaligned(features: DataFrame, labels: DataFrame, mob: int = 6) -> DataFrame:
    joined = labelled(features, labels)
    return joined.where(F.col("label_date") != F.add_months("snapshot_date", mob))


def slot_population(df: DataFrame, feature_set: str) -> DataFrame:
    """The full model sees applicants with click history only; the core model everyone."""
    return df.where(F.col("has_clickstream") == 1) if feature_set == "full" else df


def feature_columns(df: DataFrame, feature_set: str) -> list[str]:
    """Features by exclusion of keys and label columns, in the core set also of the click columns."""
    excluded = set(NOT_FEATURES)
    if feature_set == "core":
        excluded |= set(C.clickstream_features())
    return [c for c in df.columns if c not in excluded]


def matured_cohort(predictions: DataFrame, labels: DataFrame, mob: int = 6, go_live=None) -> DataFrame:
    """Scored applications with the label observed ``mob`` months after their cohort month."""
    due = predictions.withColumn("label_date", F.add_months("snapshot_date", mob))
    if go_live is not None:
        due = due.where(F.col("snapshot_date") >= F.lit(go_live).cast("date"))
    known = labels.select("loan_id", F.col("snapshot_date").alias("label_date"), "label")
    return due.join(known, ["loan_id", "label_date"])


def with_features(predictions: DataFrame, features: DataFrame, columns: list[str]) -> DataFrame:
    """Feature values of the scored applications."""
    wanted = features.select("loan_id", "snapshot_date", *columns)
    return predictions.join(wanted, ["loan_id", "snapshot_date"])


def live_versions(moments: DataFrame, registry: DataFrame, on: str, strictly_before: bool = False) -> DataFrame:
    """Version live at each (slot, date): [promoted, retired), or (promoted, retired] when deciding on that date.

    ``moments`` are distinct (slot, date) pairs and the registry has at most one version per slot and run
    month: both are bounded by the calendar. Should intervals overlap, the first trained version counts.
    """
    r = registry.where(F.col("promoted_at").isNotNull()).alias("r")
    m = moments.alias("m")
    day, start, end = F.col(f"m.{on}"), F.col("r.promoted_at"), F.col("r.retired_at")
    if strictly_before:
        live = (start < day) & (end.isNull() | (end >= day))
    else:
        live = (start <= day) & (end.isNull() | (end > day))
    hits = m.join(r, (F.col("m.slot") == F.col("r.slot")) & live)
    return hits.groupBy(F.col("m.slot").alias("slot"), day.alias(on)).agg(
        F.min_by("r.version", F.struct("r.trained_on", "r.version")).alias("version")
    )
