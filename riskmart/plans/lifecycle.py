"""The monthly model cycle: retrain, promote, score, route and monitor.

Months are walked in order, because a run depends on the registry left by the last one. Decisions, models, cards and reference profiles
are kept below one folder and read back from it, so a later session goes on where an earlier one stopped. Everything heavy in
a month is a Spark job; the driver holds registry rows (slots times run months) and the models in use.
"""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.config import Policy
from riskmart.operators import models, monitoring, populations, registry, routing, training
from riskmart.operators.splits import months_of
from riskmart.sources import cards, decisions
from riskmart.sources.tables import exists, read_range, read_table, write_table

VERSIONS = (
    "slot string, trained_on date, version string, algorithm string, data_end date, oot_auc double, threshold double,"
    " retrain_reason string, challenger_auc double, champion_version string, champion_auc double"
)
NAMES = [c.split()[0] for c in VERSIONS.split(", ")]


@dataclass
class Live:
    """A stored version: what scoring and monitoring need of it."""

    slot: str
    version: str
    algorithm: str
    model: models.Fitted
    features: list
    threshold: float
    monitored: list
    reference: DataFrame
    edges: DataFrame
    shares: DataFrame


@dataclass
class Cycle:
    """State and paths of one deployment."""

    spark: SparkSession
    root: str
    policy: Policy
    space: dict = field(default_factory=lambda: dict(training.TREE_SPACE))
    loaded: dict = field(default_factory=dict)

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def table(self, name: str) -> DataFrame | None:
        """A table of the deployment; None before its first row."""
        return read_table(self.spark, self.path(name)) if exists(self.spark, self.path(name)) else None

    def recorded(self) -> DataFrame:
        """All training runs so far, one row per slot and run month."""
        return decisions.latest(self.spark, self.root, VERSIONS)

    def record(self, row: tuple) -> None:
        """Add a run, which then counts for its slot and month, and write the tables that follow from all runs.

        The log alone is read back; the tables are for other readers and are whole again with the next run if writing them breaks off.
        """
        decisions.append(self.spark, self.root, row[0], row[1], dict(zip(NAMES, row)))
        write_table(self.registry(), self.path("registry_versions"), ["slot"])
        write_table(registry.events(self.decided()), self.path("registry_events"), ["slot"])

    def decided(self) -> DataFrame:
        return registry.recorded_promotions(self.recorded(), self.policy.promotion_tolerance)

    def registry(self) -> DataFrame:
        return registry.intervals(self.decided())

    def champion(self, slot: str, month: date, strictly_before: bool = False) -> str | None:
        asked = self.spark.createDataFrame([(slot, month)], "slot string, run_month date")
        found = populations.live_versions(asked, self.registry(), "run_month", strictly_before).first()
        return found["version"] if found else None

    def version(self, slot: str, name: str) -> Live:
        """A version as it was stored, also by an earlier session."""
        if name not in self.loaded:
            card = cards.read_cards(self.spark, self.path("cards")).where(F.col("version") == name).first()
            edges, shares, reference = (
                self.table(t).where((F.col("model_slot") == slot) & (F.col("model_version") == name)) for t in PROFILE)
            monitored = [r["variable"] for r in shares.where("variable <> 'score'").select("variable").distinct().orderBy("variable").collect()]
            model = models.load(self.spark, self.path("models"), slot, name)
            self.loaded[name] = Live(slot, name, card["algorithm"], model, card["features"], card["decision_threshold"], monitored, reference, edges, shares)
        return self.loaded[name]


PROFILE = ("profile_edges", "profile_shares", "profile_means")


def retrain_due(cycle: Cycle, slot: str, month: date, known: DataFrame) -> tuple[bool, str]:
    spark, policy = cycle.spark, cycle.policy
    months = spark.createDataFrame([(slot, month)], "slot string, run_month date")
    versions = cycle.recorded().where(F.col("trained_on") < F.lit(month))
    seen = populations.slot_population(known, policy.feature_sets[slot])
    newest = seen.agg(F.max("snapshot_date").alias("newest")).select(
        F.lit(slot).alias("slot"), F.lit(month).alias("run_month"), "newest")
    facts = cycle.table("monitoring")
    if facts is None:
        facts = spark.createDataFrame([], "monitoring_date date, model_slot string, metric string, value double, status string")
    alerts = registry.red_alerts(facts).select(F.col("model_slot").alias("slot"), "monitoring_date", "metric", "value")
    row = registry.retrain_decisions(months, versions, newest, alerts, policy).first()
    return bool(row["retrain"]), row["reason"]


def train_and_promote(cycle: Cycle, slot: str, month: date, known: DataFrame, reason: str) -> None:
    """Train a challenger and compare it with the champion on the challenger's out-of-time months."""
    new = training.train_slot(known, slot, month, cycle.policy, cycle.space)
    rival = cycle.champion(slot, month, strictly_before=True)
    rival_auc = training.auc_of(cycle.version(slot, rival).model, new.oot) if rival else None
    ends = months_of(new.oot, []).first()["months"][-1]
    models.save(cycle.spark, new.model, cycle.path("models"), slot, new.version)
    cards.write_cards(new.card(cycle.spark, reason), cycle.path("cards"))
    for name, rows in zip(PROFILE, (new.edges, new.shares, new.reference)):
        write_table(rows, cycle.path(name), ["model_slot", "model_version"])
    cycle.loaded.pop(new.version, None)
    # last, so that a run that broke off before leaves no version without its files
    cycle.record((slot, month, new.version, new.algorithm, ends, new.metrics["oot_auc"], new.threshold, reason,
                  new.metrics["oot_auc"], rival, rival_auc))


def score_month(cycle: Cycle, month: date, features: DataFrame) -> None:
    """Predictions of the live versions and the routed decisions of one run month, in place of those it had.

    A month is what was run in it: rows that start in another month belong to it too, and that other month keeps its own. One scan scores all slots; a slot without
    applicants has no rows, also if it had some before.
    """
    spark, policy = cycle.spark, cycle.policy
    apps = read_range(by_run_month(features), month, month, "run_month")
    live = {}
    for slot, kind in policy.feature_sets.items():
        version = cycle.champion(slot, month)
        if version is not None:
            live[slot] = cycle.version(slot, version)
        elif not populations.slot_population(apps, kind).isEmpty():
            raise RuntimeError(f"no live version of {slot} on {month}")
    versions = spark.createDataFrame(
        [(slot, month, t.version, t.algorithm, t.threshold) for slot, t in live.items()],
        "model_slot string, run_month date, model_version string, algorithm string, threshold double")
    scored = training.score(apps, versions, {t.version: t.model for t in live.values()}, policy, "run_month")
    only = {"run_month": (month, month)}
    write_table(scored, cycle.path("predictions"), ["run_month", "model_slot"], within=only)
    routed = routing.route(read_range(cycle.table("predictions"), month, month, "run_month"))
    if routing.routed_twice(routed).first()["n_repeated"]:
        raise RuntimeError(f"an application of {month} would be decided twice")
    write_table(routed, cycle.path("production"), ["run_month"], within=only)


def by_run_month(features: DataFrame) -> DataFrame:
    """Features with their run month; without one it is the month in which the loan starts."""
    return features if "run_month" in features.columns else features.withColumn("run_month", F.col("snapshot_date"))


def cohort_rows(scored: DataFrame, *months) -> DataFrame:
    """Scored rows of run months, which are their cohorts."""
    return scored.where(F.col("run_month").isin([*months])).withColumn("snapshot_date", F.col("run_month"))


def monitor_month(cycle: Cycle, month: date, features: DataFrame, labels: DataFrame) -> None:
    """Stability of the month's scores and performance of the cohort whose labels mature this month; both by run month."""
    policy, parts = cycle.policy, []
    predictions, production = cycle.table("predictions"), cycle.table("production")
    if predictions is None:
        return
    now = cohort_rows(predictions, month)
    if not now.isEmpty():
        live = [cycle.version(*r) for r in now.select("model_slot", "model_version").distinct().orderBy("model_slot", "model_version").collect()]
        own_features = cohort_rows(by_run_month(features), month)
        for t in live:
            own = now.where(F.col("model_version") == t.version)
            valued = populations.with_features(own, own_features, t.monitored)
            parts.append(monitoring.stability_by_slot(valued, t.reference, t.edges, t.shares, t.monitored, policy))
        routed = cohort_rows(production, month, policy.go_live)
        parts.append(monitoring.stability_production(routed, policy).where(F.col("cohort_date") == F.lit(month)))
    cohort = month_before(month, policy.label_mob)
    mature = read_range(labels, month, month)
    oot = cycle.registry().select(F.col("slot").alias("model_slot"), F.col("version").alias("model_version"), "oot_auc")
    by_slot = populations.matured_cohort(cohort_rows(predictions, cohort), mature, policy.label_mob, policy.go_live)
    pooled = populations.matured_cohort(cohort_rows(production, cohort), mature, policy.label_mob, policy.go_live)
    parts += [monitoring.performance_by_slot(by_slot, oot, policy), monitoring.performance_of_production(pooled, oot, policy)]
    write_table(reduce(DataFrame.unionByName, parts), cycle.path("monitoring"), ["monitoring_date"], within={"monitoring_date": (month, month)})


def month_before(month: date, months: int) -> date:
    place = month.year * 12 + month.month - 1 - months
    return date(place // 12, place % 12 + 1, 1)


def run(spark: SparkSession, root: str, features: DataFrame, labels: DataFrame, months: list[date], policy: Policy = Policy(),
        space: dict = training.TREE_SPACE) -> Cycle:
    """Walk the months in order; what earlier calls left below ``root`` is read back, so single months can be run one by one."""
    cycle = Cycle(spark, root, policy, dict(space))
    spark.createDataFrame([(json.dumps(dataclasses.asdict(policy), default=str, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(cycle.path("policy"))
    for month in months:
        known = populations.labelled(features, labels, month.isoformat())
        for slot in policy.feature_sets:
            due, reason = retrain_due(cycle, slot, month, known)
            if due:
                train_and_promote(cycle, slot, month, known, reason)
        if month >= policy.go_live and not cycle.recorded().isEmpty():
            score_month(cycle, month, features)
            monitor_month(cycle, month, features, labels)
    return cycle
