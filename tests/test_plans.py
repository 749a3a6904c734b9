"""Files to gold stores, and the monthly model cycle, on the smallest tables."""

import json
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.config import Policy
from riskmart.operators import training
from riskmart.plans import backfill, gold_queries, lifecycle
from riskmart.plans.views import view
from riskmart.session import run_folder
from riskmart.sources import cards, raw, tables

POLICY = replace(
    Policy(), pipeline_start=date(1995, 1, 1), pipeline_end=date(2001, 12, 1), feature_start=date(1995, 1, 1),
    feature_end=date(2001, 8, 1), go_live=date(2000, 1, 1), search_draws=1, cv_folds=1,
)

EARLY = replace(POLICY, pipeline_end=date(1996, 3, 1), feature_end=date(1995, 9, 1))


@pytest.fixture(scope="module")
def sources(spark, sf):
    found = {}
    for table, name in (("loan_daily", "v_loan_daily"), ("attributes", "v_attributes"), ("financials", "v_financials"), ("clickstream", "v_click_months")):
        found[table] = run_folder(spark, f"csv-{table}")
        view(spark, sf, name).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(found[table])
    return found


def test_backfill_equals_the_direct_stores(spark, sf, sources):
    root = run_folder(spark, "mart")
    first = backfill.run(spark, sources, root, EARLY).first()
    # a quarter again: nothing is doubled or lost
    again = backfill.run(spark, sources, root, EARLY, date(1995, 4, 1), date(1995, 6, 1)).first()
    assert first == again and first["n_misaligned"] == 0 and first["n_labels"] > 0
    features, labels = backfill.stores(spark, root)
    want = gold_queries.features(spark, sf).where("snapshot_date <= date '1995-09-01'")
    columns = ["loan_id", "snapshot_date", "tenure", "Age", "num_loan_types", "clickstream_months_observed", "credit_mix_ordinal"]
    got, expected = ({tuple(r) for r in df.select(columns).collect()} for df in (features, want))
    assert got == expected and features.count() == len(got) > 0
    assert len(want.columns) == 81
    known = gold_queries.labels(spark, sf).where("snapshot_date <= date '1996-03-01'").select("loan_id", "label")
    assert {tuple(r) for r in labels.select("loan_id", "label").collect()} == {tuple(r) for r in known.collect()}


def test_one_month_again_keeps_the_others(spark, sf, sources):
    """A rebuilt month whose rows start in other months, in a store that holds those months too."""
    root, loans = run_folder(spark, "again"), run_folder(spark, "csv-foreign")
    foreign = (F.col("loan_id").cast("long") % 10 == 0) & (F.col("installment_num") == 1)
    rows = view(spark, sf, "v_loan_daily").withColumn("installment_num", F.when(foreign, F.lit("n/a")).otherwise(F.col("installment_num").cast("string")))
    rows.write.options(header=True).csv(loans)
    mixed = sources | {"loan_daily": loans}
    backfill.run(spark, mixed, root, EARLY)
    count = lambda: {tuple(r) for r in backfill.stores(spark, root)[0].groupBy("run_month", "snapshot_date").count().collect()}
    before = count()
    assert any(r[0] != r[1] for r in before)
    backfill.run(spark, mixed, root, EARLY, date(1995, 3, 1), date(1995, 3, 1))
    assert count() == before


def test_first_months_have_no_label(spark, sources):
    root = run_folder(spark, "first")
    summary = backfill.run(spark, sources, root, EARLY, date(1995, 1, 1), date(1995, 2, 1)).first()
    assert summary["n_labels"] == 0 and summary["n_features"] > 0 and summary["n_matured"] == 0


def test_contract_failure(spark):
    with pytest.raises(ValueError):
        raw.require_columns(spark.range(1), ["loan_id"], "loans")


def test_quotes_survive(spark):
    path = run_folder(spark, "quotes")
    spark.createDataFrame([('ODonnell"d, x', "1")], "Name string, n string").write.options(header=True, escape='"').csv(path)
    assert raw.read_raw(spark, path).first()["Name"] == 'ODonnell"d, x'


def test_partition_pruning_and_narrow_reads(spark, sf):
    path = run_folder(spark, "pruned")
    tables.write_table(view(spark, sf, "v_loan_daily"), path, ["snapshot_date"])
    read = tables.read_table(spark, path, "1996-01-01", "1996-06-01", ["loan_id"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<loan_id:string>" in plan


def test_monthly_cycle(spark, sf):
    """Two months with a retrain in the first: train, promote, score, route, monitor; a second run changes nothing."""
    root = run_folder(spark, "cycle")
    features = tables.stored(gold_queries.features(spark, sf), "features")
    labels = tables.stored(gold_queries.labels(spark, sf), "labels")
    space = {**training.TREE_SPACE, "n_estimators": [3], "max_depth": [2]}
    policy = replace(POLICY, feature_sets={"model_2": "core"})
    first = lifecycle.run(spark, root, features, labels, [date(2000, 1, 1)], policy, space)
    assert [r["version"] for r in first.recorded().collect()] == ["model_2_2000_01_01"]
    # another process: nothing but the folder is shared
    cycle = lifecycle.run(spark.newSession(), root, features, labels, [date(2000, 2, 1)], policy, space)
    assert [r["version"] for r in cycle.recorded().collect()] == ["model_2_2000_01_01"] and list(cycle.loaded) == ["model_2_2000_01_01"]
    assert cycle.table("registry_versions").first()["status"] == "champion"
    assert cycle.table("registry_events").first()["event"] == "promoted"
    assert json.loads(spark.read.text(cycle.path("policy")).first()["value"])["go_live"] == "2000-01-01"
    production = cycle.table("production")
    assert production.count() == production.select("loan_id").distinct().count() == features.where(
        F.col("snapshot_date").isin(date(2000, 1, 1), date(2000, 2, 1))).count()
    facts = cycle.table("monitoring")
    assert {"n_scored", "psi_score", "clickstream_coverage"} <= {r["metric"] for r in facts.select("metric").distinct().collect()}
    assert {r[0] for r in facts.where("metric = 'mean_score' and model_slot = 'model_2'").select(F.col("reference_value").isNotNull()).collect()} == {True}
    card = cards.read_cards(spark, cycle.path("cards")).first()
    assert card["slot"] == "model_2" and json.loads(json.dumps(card["metrics"]))["oot_auc"] is not None
    # both months in one call give the same scores
    whole = lifecycle.run(spark, run_folder(spark, "whole"), features, labels, [date(2000, 1, 1), date(2000, 2, 1)], policy, space)
    scores = lambda c: {tuple(r) for r in c.table("predictions").select("loan_id", "snapshot_date", F.round("score", 9), "decision").collect()}
    assert scores(whole) == scores(cycle)
