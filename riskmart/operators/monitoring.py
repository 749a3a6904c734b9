"""Monitoring facts in long form: one row per metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.config import Policy
from riskmart.functions import status as light
from riskmart.operators import drift
from riskmart.operators.metrics import cutoff_summary, rank_metrics
from riskmart.sources.tables import stored

COHORT = ["model_slot", "model_version", "snapshot_date"]
FACT = [
    "monitoring_date", "model_slot", "model_version", "cohort_date", "metric_group", "metric", "value",
    "reference_value", "status",
]


def fact(metric, value, reference=None, status=None) -> Column:
    def number(x):
        return (F.col(x) if isinstance(x, str) else F.lit(None) if x is None else x).cast("double")
    name = F.lit(metric) if isinstance(metric, str) else metric
    return F.struct(
        name.alias("metric"), number(value).alias("value"), number(reference).alias("reference_value"),
        (F.lit("info") if status is None else status).alias("status"),
    )


def long_rows(df: DataFrame, group: str, monitored: Column, facts: list[Column]) -> DataFrame:
    """One output row per fact for each row of df, which has the columns of COHORT."""
    return df.select(
        monitored.alias("monitoring_date"), "model_slot", "model_version",
        F.col("snapshot_date").alias("cohort_date"), F.lit(group).alias("metric_group"),
        F.inline(F.array(*facts)),
    )


def reference_profile(reference: DataFrame, keys: list[str], variables: list[str]) -> tuple[DataFrame, DataFrame]:
    """Bin edges and bin shares of every variable over the reference rows: (edges, shares) in long form.

    Both rest on stored tables, as a profile is kept with its model version.
    """
    long = drift.melt(reference, keys, variables)
    by = keys + ["variable"]
    edges, shares = drift.profile(long, by)
    return stored(edges, "edges"), stored(shares, "shares")


def variable_drift(current: DataFrame, edges: DataFrame, shares: DataFrame, keys: list[str],
                   reference_keys: list[str], variables: list[str]) -> DataFrame:
    """(keys, variable, psi, missing_rate, reference_missing)."""
    long = drift.melt(current, keys, variables)
    by, ref_by = keys + ["variable"], reference_keys + ["variable"]
    now = drift.proportions(drift.bin_counts(long, edges, by, ref_by), by)
    return drift.psi(now, shares, by, ref_by)


def score_volume(predictions: DataFrame, keys: list[str]) -> DataFrame:
    return predictions.groupBy(*keys).agg(
        F.count("*").alias("n_scored"), F.avg("score").alias("mean_score"),
        F.avg((F.col("decision") == "approve").cast("int")).alias("approval_rate"),
    )


def stability_by_slot(predictions: DataFrame, references: DataFrame, edges: DataFrame, shares: DataFrame,
                      features: list[str], policy: Policy) -> DataFrame:
    """Volume, mean score, approval rate, score PSI, and CSI and missing rate of each monitored feature.

    ``predictions`` carry the feature values; ``references`` has (model_slot, model_version, mean_score,
    approval_rate) at training; edges and shares come from ``reference_profile`` over score and features.
    """
    version = ["model_slot", "model_version"]
    base = references.select(*version, F.col("mean_score").alias("ref_score"), F.col("approval_rate").alias("ref_rate"))
    volume = score_volume(predictions, COHORT).join(base, version, "left")
    counts = long_rows(volume, "stability", F.col("snapshot_date"), [
        fact("n_scored", "n_scored"), fact("mean_score", "mean_score", "ref_score"),
        fact("approval_rate", "approval_rate", "ref_rate"),
    ])
    shift = variable_drift(predictions, edges, shares, COHORT, version, ["score", *features])
    lights = light.high_is_bad(F.col("psi"), policy.psi_lights)
    is_score = F.col("variable") == "score"
    risen = F.col("missing_rate") - F.coalesce("reference_missing", F.lit(0.0))
    drifted = long_rows(shift, "stability", F.col("snapshot_date"), [
        fact(F.when(is_score, "psi_score").otherwise(F.concat(F.lit("csi__"), "variable")), "psi", None, lights),
        fact(F.when(~is_score, F.concat(F.lit("missing__"), "variable")), "missing_rate", "reference_missing",
             light.red_above(risen, policy.missing_increase_red)),
    ])
    return counts.unionByName(drifted.where(F.col("metric").isNotNull()))


def stability_production(routed: DataFrame, policy: Policy) -> DataFrame:
    """Volumes, routing shares and click coverage against the go-live month, one pass over the decisions."""
    monthly = routed.groupBy("snapshot_date").agg(
        F.count("*").alias("n_scored"),
        F.avg((F.col("routed_to") == "model_1").cast("int")).alias("share_1"),
        F.avg("score").alias("mean_score"),
        F.avg((F.col("decision") == "approve").cast("int")).alias("approval_rate"),
        F.avg("has_clickstream").alias("coverage"),
    ).select("*", F.lit(C.PRODUCTION).alias("model_slot"), F.lit("routed").alias("model_version"))
    base = routed.where(F.col("snapshot_date") == F.lit(policy.go_live)).agg(F.avg("has_clickstream")).scalar()
    monthly = monthly.withColumn("base", base)
    facts = long_rows(monthly, "stability", F.col("snapshot_date"), [
        fact("n_scored", "n_scored"), fact("share_routed_model_1", "share_1"),
        fact("share_routed_model_2", 1 - F.col("share_1")), fact("mean_score", "mean_score"),
        fact("approval_rate", "approval_rate"),
        fact("clickstream_coverage", "coverage", "base",
             light.red_above(F.col("base") - F.col("coverage"), policy.missing_increase_red)),
    ])
    # without a go-live month there is nothing to compare the coverage with
    return facts.where((F.col("metric") != "clickstream_coverage") | F.col("reference_value").isNotNull())


def performance(matured: DataFrame, expected: DataFrame, expected_by: list[str], policy: Policy) -> DataFrame:
    """Fourteen metrics per cohort whose labels have matured.

    ``matured`` has predictions with label and threshold; ``expected`` has ``ref_auc`` by ``expected_by``.
    """
    keys = list(COHORT)
    ranks = rank_metrics(matured, keys)
    cut = cutoff_summary(matured, keys, also=[F.avg("label").alias("actual"), F.avg("score").alias("predicted")])
    joined = cut.join(ranks, keys, "left").join(expected, expected_by, "left")
    gap = F.abs(F.col("predicted") - F.col("actual"))
    drop = F.col("ref_auc") - F.col("auc")
    return long_rows(joined, "performance", F.add_months("snapshot_date", policy.label_mob), [
        fact("n_labelled", "n"), fact("actual_default_rate", "actual"), fact("mean_predicted_pd", "predicted"),
        fact("calibration_gap", gap, None, light.high_is_bad(gap, policy.calibration_lights)),
        fact("auc", "auc", "ref_auc", light.high_is_bad(drop, policy.auc_drop_lights)),
        fact("gini", "gini", 2 * F.col("ref_auc") - 1), fact("ks", "ks"),
        *[fact(m, m) for m in ("accuracy", "precision", "recall", "f1", "approval_rate", "bad_rate_approved",
                               "bad_rate_declined")],
    ])


def expected_auc(decisions: DataFrame, oot: DataFrame, keys: list[str]) -> DataFrame:
    """Out-of-time AUC of the deciding versions weighted by volume: (keys, ref_auc).

    Counted per version first, so only (keys, slot, version) totals meet the registry.
    """
    volume = decisions.groupBy(*keys, "routed_to", "model_version").agg(F.count("*").alias("n"))
    scored = volume.join(oot.withColumnRenamed("model_slot", "routed_to"), ["routed_to", "model_version"], "left")
    # a version unknown to the registry leaves the expectation unknown
    complete = F.count("oot_auc") == F.count(F.lit(1))
    weighted = F.sum(F.col("oot_auc") * F.col("n")) / F.sum("n")
    return scored.groupBy(*keys).agg(F.when(complete, weighted).alias("ref_auc"))


def performance_by_slot(matured: DataFrame, oot: DataFrame, policy: Policy) -> DataFrame:
    version = ["model_slot", "model_version"]
    return performance(matured, oot.select(*version, F.col("oot_auc").alias("ref_auc")), version, policy)


def performance_of_production(matured_routed: DataFrame, oot: DataFrame, policy: Policy) -> DataFrame:
    """Pooled over the versions that decided."""
    expected = expected_auc(matured_routed, oot, ["snapshot_date"])
    pooled = matured_routed.drop("model_version").withColumn("model_version", F.lit("routed"))
    return performance(pooled, expected, ["snapshot_date"], policy)
