"""Report datasets: the tables behind each chart, from the monitoring facts and the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.config import Policy

SLOTS = ["model_1", "model_2", C.PRODUCTION]


def as_of(facts: DataFrame, run_date) -> DataFrame:
    return facts.where(F.col("monitoring_date") <= F.lit(run_date).cast("date"))


def by_slot(facts: DataFrame, group: str, metric: str, slots=SLOTS) -> DataFrame:
    """(cohort_date, one column per slot): mean value of a metric."""
    chosen = facts.where((F.col("metric_group") == group) & (F.col("metric") == metric))
    return chosen.groupBy("cohort_date").pivot("model_slot", list(slots)).agg(F.avg("value"))


def by_metric(facts: DataFrame, group: str, metrics: list[str], slot: str = C.PRODUCTION) -> DataFrame:
    """(cohort_date, one column per metric) of one slot."""
    chosen = facts.where(
        (F.col("metric_group") == group) & (F.col("model_slot") == slot) & F.col("metric").isin(metrics)
    )
    return chosen.groupBy("cohort_date").pivot("metric", metrics).agg(F.avg("value"))


def outage_start(facts: DataFrame) -> DataFrame:
    """First month with red click coverage; null when there is none."""
    red = (F.col("model_slot") == C.PRODUCTION) & (F.col("metric") == "clickstream_coverage") & (F.col("status") == "red")
    return facts.where(red).agg(F.min("cohort_date").alias("outage_start"))


def auc_by_month(facts: DataFrame, policy: Policy) -> DataFrame:
    """AUC of each model with the alert line: expected production AUC minus the red drop."""
    aucs = by_slot(facts, "performance", "auc", ["model_1", "model_2"])
    line = facts.where((F.col("model_slot") == C.PRODUCTION) & (F.col("metric") == "auc")).groupBy("cohort_date").agg(
        (F.max("reference_value") - policy.auc_drop_lights[1]).alias("alert_line")
    )
    return aucs.join(line, "cohort_date", "full")


def psi_by_month(facts: DataFrame) -> DataFrame:
    return by_slot(facts, "stability", "psi_score", ["model_1", "model_2"])


def calibration(facts: DataFrame) -> DataFrame:
    """Actual and predicted default rate by month, with the largest gap of all months."""
    series = by_metric(facts, "performance", ["actual_default_rate", "mean_predicted_pd"])
    gap = F.abs(F.col("mean_predicted_pd") - F.col("actual_default_rate"))
    return series.withColumn("largest_gap", series.agg(F.max(gap)).scalar())


def routing(facts: DataFrame) -> DataFrame:
    """Applications decided by each model; halves round to even."""
    p = by_metric(facts, "stability", ["n_scored", "share_routed_model_1"])
    first = F.bround(F.col("n_scored") * F.col("share_routed_model_1"))
    return p.select(
        "cohort_date", first.cast("long").alias("n_model_1"), (F.col("n_scored") - first).cast("long").alias("n_model_2")
    )


def business(facts: DataFrame) -> DataFrame:
    """Approval and default rates by month with the means of both default rates."""
    p = by_metric(facts, "performance", ["approval_rate", "actual_default_rate", "bad_rate_approved"])
    means = p.agg(F.struct(
        F.avg("bad_rate_approved").alias("approved"), F.avg("actual_default_rate").alias("actual")
    )).scalar()
    return p.select(
        "*", means.getField("approved").alias("mean_bad_rate_approved"), means.getField("actual").alias("mean_default_rate")
    )


def csi_order(facts: DataFrame, n: int) -> DataFrame:
    """(model_slot, feature, position): features by latest CSI, then those absent from the latest month."""
    csi = _csi(facts)
    latest = csi.groupBy("model_slot").agg(F.max("cohort_date").alias("newest"))
    last = csi.join(latest, "model_slot").groupBy("model_slot", "feature").agg(
        F.max(F.when(F.col("cohort_date") == F.col("newest"), F.col("value"))).alias("latest")
    )
    order = W.partitionBy("model_slot").orderBy(F.desc_nulls_last("latest"), "feature")
    return last.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def csi_matrix(facts: DataFrame, n: int) -> DataFrame:
    """(model_slot, feature, position, cohort_date, csi): the top features by month."""
    cells = _csi(facts).groupBy("model_slot", "feature", "cohort_date").agg(F.avg("value").alias("csi"))
    return cells.join(csi_order(facts, n).drop("latest"), ["model_slot", "feature"])


def csi_wide(facts: DataFrame, n: int, months: list) -> DataFrame:
    """The matrix with one column per month."""
    matrix = csi_matrix(facts, n)
    return matrix.groupBy("model_slot", "position", "feature").pivot("cohort_date", list(months)).agg(F.avg("csi"))


def _csi(facts: DataFrame) -> DataFrame:
    chosen = facts.where((F.col("metric_group") == "stability") & F.col("metric").startswith("csi__"))
    return chosen.withColumn("feature", F.substring_index("metric", "csi__", -1))


def production_table(facts: DataFrame) -> DataFrame:
    return by_metric(facts, "performance", [
        "n_labelled", "auc", "gini", "ks", "actual_default_rate", "mean_predicted_pd", "approval_rate",
        "bad_rate_approved", "bad_rate_declined",
    ])


def alerts(facts: DataFrame) -> DataFrame:
    """Amber and red facts by date, slot and metric."""
    return facts.where(F.col("status").isin("amber", "red")).select(
        "monitoring_date", "model_slot", "model_version", "cohort_date", "metric", "value", "reference_value", "status"
    ).orderBy("monitoring_date", "model_slot", "metric")
