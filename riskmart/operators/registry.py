"""Version history: promotion gate, live intervals, events and the retrain decision.

These tables hold one row per slot and run month at most, so their size is set by the calendar and not by
the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.config import Policy
from riskmart.operators.calendar import is_scheduled

DECISION = "struct<trained_on:date,version:string,challenger_auc:double,champion_version:string,champion_auc:double,promoted:boolean>"


def version_name(slot: Column, trained_on: Column) -> Column:
    return F.concat_ws("_", slot, F.date_format(trained_on, "yyyy_MM_dd"))


def passes(challenger_auc: Column, champion: Column, champion_auc: Column, tolerance: float) -> Column:
    """The gate: a first version passes; another one only if both AUCs are known and it is not behind."""
    return champion.isNull() | F.coalesce(challenger_auc >= champion_auc - tolerance, F.lit(False))


def promotions(evaluations: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Outcome of every run: slot, trained_on, version, challenger_auc, champion_version, champion_auc, promoted.

    ``evaluations`` has (slot, trained_on, version, scored_version, auc): the AUC of the challenger ``version``
    and of the earlier versions on the out-of-time months of the run. Whom a challenger meets depends on all earlier
    outcomes, so each slot's runs are folded in date order over one array entry per run month. A champion
    without a score on those months loses no comparison: the challenger is rejected.
    """
    aucs = F.map_from_entries(F.collect_list(F.struct("scored_version", "auc"))).alias("aucs")
    runs = evaluations.groupBy("slot", "trained_on", "version").agg(aucs)
    # date order by position: maps cannot be sorted, so they are looked up per date
    per_slot = runs.groupBy("slot").agg(
        F.sort_array(F.collect_list(F.struct("trained_on", "version"))).alias("runs"),
        F.map_from_entries(F.collect_list(F.struct("trained_on", "aucs"))).alias("by_run"),
    )

    def step(state, run):
        scores = F.element_at(F.col("by_run"), run["trained_on"])
        own = F.element_at(scores, run["version"])
        champion = state["champion"]
        rival = F.when(champion.isNotNull(), F.element_at(scores, champion))
        wins = passes(own, champion, rival, tolerance)
        decision = F.struct(
            run["trained_on"].alias("trained_on"), run["version"].alias("version"), own.alias("challenger_auc"),
            champion.alias("champion_version"), rival.alias("champion_auc"), wins.alias("promoted"),
        )
        return F.struct(
            F.when(wins, run["version"]).otherwise(champion).alias("champion"),
            F.concat(state["decisions"], F.array(decision.cast(DECISION))).alias("decisions"),
        )

    start = F.struct(
        F.lit(None).cast("string").alias("champion"), F.array().cast(f"array<{DECISION}>").alias("decisions")
    )
    folded = per_slot.select("slot", F.aggregate("runs", start, step)["decisions"].alias("decisions"))
    return folded.select("slot", F.inline("decisions"))


def recorded_promotions(decisions: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Gate applied to recorded pairs (slot, trained_on, version, challenger_auc, champion_version, champion_auc)."""
    wins = passes(F.col("challenger_auc"), F.col("champion_version"), F.col("champion_auc"), tolerance)
    return decisions.withColumn("promoted", wins)


def intervals(decisions: DataFrame) -> DataFrame:
    """Registry rows rebuilt from all decisions: each promoted version is live until the next promotion.

    Built from the decisions alone, so running a month again cannot leave two live versions.
    """
    live = W.partitionBy("slot").orderBy("trained_on")
    promoted = decisions.where("promoted").select(
        "*", F.col("trained_on").alias("promoted_at"), F.lead("trained_on").over(live).alias("retired_at"),
    )
    rejected = decisions.where(~F.col("promoted"))
    both = promoted.unionByName(rejected, allowMissingColumns=True)
    status = (
        F.when(~F.col("promoted"), "rejected").when(F.col("retired_at").isNull(), "champion").otherwise("retired")
    )
    return both.withColumn("status", status)


def events(decisions: DataFrame) -> DataFrame:
    """Event log of the decisions."""
    def auc(c):
        return F.format_string("%.3f", F.bround(c, 3))
    detail = F.when(
        F.col("champion_version").isNull(), F.concat(F.lit("first deployment; OOT AUC "), auc("challenger_auc"))
    ).otherwise(F.concat(
        F.lit("challenger "), F.col("version"), F.lit(" AUC "), auc("challenger_auc"),
        F.lit(" vs champion "), F.col("champion_version"), F.lit(" AUC "), auc("champion_auc"),
    ))
    return decisions.select(
        F.col("trained_on").alias("date"), "slot",
        F.when(F.col("promoted"), "promoted").otherwise("rejected").alias("event"), "version", detail.alias("detail"),
    )


def upsert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Table with the rows of the same key replaced and new ones added."""
    kept = table.join(rows.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def timeline(registry: DataFrame, end) -> DataFrame:
    """All versions: the live span of the promoted ones, open ones running to the end of the window, and the day on which the others were rejected.

    The algorithm is shown where the registry has it.
    """
    stop = F.when(F.col("promoted_at").isNotNull(), F.coalesce("retired_at", F.lit(end).cast("date")))
    algorithm = [F.col("algorithm")] if "algorithm" in registry.columns else []
    return registry.select(
        "slot", "version", *algorithm, F.col("challenger_auc").alias("oot_auc"), F.col("promoted_at").alias("start"), stop.alias("stop"),
        F.datediff(stop, F.col("promoted_at")).alias("days_live"), F.when(~F.col("promoted"), F.col("trained_on")).alias("rejected_on"),
    )


def red_alerts(monitoring: DataFrame, metrics=C.TRIGGER_METRICS) -> DataFrame:
    return monitoring.where((F.col("status") == "red") & F.col("metric").isin(list(metrics)))


def retrain_decisions(
    months: DataFrame, versions: DataFrame, labelled_until: DataFrame, alerts: DataFrame, policy: Policy
) -> DataFrame:
    """Whether each (slot, run month) retrains, and why, first matching rule in this order:
    before go-live, after the last applications, first deployment, nothing new labelled, scheduled month, red alert.

    months: slot, run_month. versions: slot, version, trained_on, data_end. labelled_until: slot, run_month,
    newest. alerts: slot, monitoring_date, metric, value. All have one row per slot and month at most (alerts: a
    few).
    """
    run = F.col("run_month")
    trained = versions.select("slot", "version", "trained_on", "data_end")
    last = months.join(trained, "slot").where(F.col("trained_on") < run).groupBy("slot", "run_month").agg(
        F.max(F.struct("trained_on", "version", "data_end")).alias("last")
    )
    known = months.join(last, ["slot", "run_month"], "left").join(labelled_until, ["slot", "run_month"], "left")
    since = F.col("last.trained_on")
    hit = known.select("slot", "run_month", since.alias("since")).join(alerts, "slot").where(
        (F.col("monitoring_date") > F.col("since")) & (F.col("monitoring_date") < run)
    ).groupBy("slot", "run_month").agg(F.max(F.struct("monitoring_date", "metric", "value")).alias("alert"))
    full = known.join(hit, ["slot", "run_month"], "left")

    stale = F.col("newest").isNull() | (F.col("newest") <= F.col("last.data_end"))
    def said(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    alert = F.col("alert")
    rules = [
        (run < F.lit(policy.go_live), False, said(f"before go-live ({policy.go_live})")),
        (run > F.lit(policy.feature_end), False, said(f"no new applications to score after {policy.feature_end}")),
        (F.col("last").isNull(), True, said("first deployment (go-live)")),
        (stale, False, said("no new labelled applications since ", F.col("last.version"), " (newest month ", F.coalesce(F.col("newest").cast("string"), F.lit("none")), ")")),
        (is_scheduled(run, policy), True, said(f"scheduled retrain (every {policy.retrain_every_months} months from go-live)")),
        (alert.isNotNull(), True, said("red alert: ", alert["metric"], "=", F.format_string("%.3f", F.bround(alert["value"], 3)), " on ", alert["monitoring_date"])),
    ]
    due, reason = F.lit(False), said("not a scheduled month and no red alerts since ", F.col("last.trained_on"))
    for condition, outcome, text in reversed(rules):
        due = F.when(condition, F.lit(outcome)).otherwise(due)
        reason = F.when(condition, text).otherwise(reason)
    return full.select(
        "slot", "run_month", due.cast("int").alias("retrain"), reason.alias("reason"),
        F.col("last.version").alias("last_version"), "newest",
        F.col("alert.metric").alias("alert_metric"), F.col("alert.monitoring_date").alias("alert_date"),
    )


def better_algorithm(results: DataFrame, keys: list[str], simple: str, tolerance: float) -> DataFrame:
    """Algorithm with the best test AUC; the simple one when it is within the tolerance of the best."""
    best = F.max_by("algorithm", F.struct("test_auc", F.col("algorithm") == simple))
    plain = F.max(F.when(F.col("algorithm") == simple, F.col("test_auc")))
    grouped = results.groupBy(*keys).agg(best.alias("best"), F.max("test_auc").alias("top"), plain.alias("plain"))
    tied = F.coalesce(F.col("top") - F.col("plain") <= tolerance, F.lit(False))
    return grouped.select(
        *keys, F.when(tied, F.lit(simple)).otherwise(F.col("best")).alias("algorithm"),
        F.when(tied, F.col("plain")).otherwise(F.col("top")).alias("test_auc"),
    )
