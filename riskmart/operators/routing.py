"""Scoring decisions and production routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import config as C


def decide(scored: DataFrame) -> DataFrame:
    """Decline at or above the threshold."""
    return scored.withColumn("decision", F.when(F.col("score") >= F.col("threshold"), "decline").otherwise("approve"))


def route(predictions: DataFrame) -> DataFrame:
    """Production decisions: the full model's row where it exists, else the core model's."""
    full = predictions.where(F.col("model_slot") == "model_1")
    core = predictions.where(F.col("model_slot") == "model_2")
    taken = full.select("loan_id", "snapshot_date").distinct()
    fallback = core.join(taken, ["loan_id", "snapshot_date"], "left_anti")
    return (
        full.unionByName(fallback, allowMissingColumns=True)
        .withColumnRenamed("model_slot", "routed_to")
        .withColumn("model_slot", F.lit(C.PRODUCTION))
    )


def routed_twice(routed: DataFrame) -> DataFrame:
    """Data-quality count: production must decide each loan once per month."""
    counts = routed.groupBy("loan_id", "snapshot_date").count()
    return counts.agg(F.count("*").alias("n_loans"), F.count_if(F.col("count") > 1).alias("n_repeated"))
