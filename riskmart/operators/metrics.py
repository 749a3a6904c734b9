"""Rank and cut-off metrics per group, exact and spread over tasks however large a group is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.ordered import running_totals


def roc_curve(df: DataFrame, keys: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """One row per (keys, distinct score), highest first: counts at and above it, true and false positive rate.

    Rates are null in groups with one class only.
    """
    counted = df.select(
        *keys, score,
        F.col(label).cast("long").alias("pos"), (1 - F.col(label)).cast("long").alias("neg"),
    )
    runs = running_totals(counted, keys, score, ["pos", "neg"], descending=True)
    two = (F.col("total_pos") > 0) & (F.col("total_neg") > 0)
    return runs.select(
        *keys, F.col(score).alias("threshold"), "pos", "neg", "cum_pos", "cum_neg", "total_pos", "total_neg",
        F.when(two, F.col("cum_pos") / F.col("total_pos")).alias("tpr"),
        F.when(two, F.col("cum_neg") / F.col("total_neg")).alias("fpr"),
    )


def rank_metrics(df: DataFrame, keys: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """auc, gini, ks and ks_cutoff per group; auc, gini and ks are null in groups with one class only.

    auc: share of (bad, good) pairs ranked rightly, ties half. ks_cutoff: highest score at the widest gap, within
    [0, 1]; 1 when declining nobody is best.
    """
    curve = roc_curve(df, keys, score, label)
    above = F.col("cum_pos") - F.col("pos") / 2
    area = F.sum(F.try_divide(F.col("neg") * above, F.col("total_neg") * F.col("total_pos").cast("double")))
    gap = F.col("tpr") - F.col("fpr")
    best = F.max(F.struct(gap.alias("gap"), F.col("threshold"))).alias("best")
    grouped = curve.groupBy(*keys).agg(
        area.alias("auc"), best, F.max("total_pos").alias("n_bad"), F.max("total_neg").alias("n_good"),
    )
    return grouped.select(
        *keys, "n_bad", "n_good", "auc", (2 * F.col("auc") - 1).alias("gini"),
        F.greatest(F.col("best.gap"), F.when(F.col("best.gap").isNotNull(), 0.0)).alias("ks"),
        F.when(F.col("best.gap") > 0, F.greatest(F.least(F.col("best.threshold"), F.lit(1.0)), F.lit(0.0)))
        .otherwise(F.lit(1.0)).alias("ks_cutoff"),
    )


def _share(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def cutoff_summary(
    df: DataFrame, keys: list[str], score="score", label="label", threshold="threshold", also: list[Column] = ()
) -> DataFrame:
    """Business view of a cut-off that may differ by row; shares of nothing are null.

    ``also``: further named aggregates to take in the same pass.
    """
    declined = F.col(score) >= F.col(threshold)
    bad = F.col(label) == 1
    counts = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(bad & declined).alias("tp"), F.count_if(~bad & declined).alias("fp"),
        F.count_if(bad & ~declined).alias("fn"), F.count_if(~bad & ~declined).alias("tn"), *also,
    )
    extra = [c for c in counts.columns if c not in (*keys, "n", "tp", "fp", "fn", "tn")]
    c = {n: F.col(n) for n in ("n", "tp", "fp", "fn", "tn")}
    precision, recall = _share(c["tp"], c["tp"] + c["fp"]), _share(c["tp"], c["tp"] + c["fn"])
    return counts.select(
        *keys, *c.values(),
        _share(c["tp"] + c["tn"], c["n"]).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _share(2 * precision * recall, precision + recall).alias("f1"),
        _share(c["fn"] + c["tn"], c["n"]).alias("approval_rate"),
        _share(c["fn"], c["fn"] + c["tn"]).alias("bad_rate_approved"),
        precision.alias("bad_rate_declined"),
        *extra,
    )


def missing_rates(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Share of null or NaN values per column in one pass, as (keys, variable, missing_rate)."""
    kinds = dict(df.dtypes)

    def absent(c):
        null = F.col(c).isNull()
        return null | F.isnan(c) if kinds[c] in ("float", "double") else null

    rates = df.groupBy(*keys).agg(*[F.avg(absent(c).cast("int")).alias(c) for c in columns])
    return rates.unpivot(keys, columns, "variable", "missing_rate")
