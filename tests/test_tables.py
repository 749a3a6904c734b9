"""Replacement of partitions, the decision log, and months scored again."""

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.config import Policy
from riskmart.operators import logistic, models
from riskmart.plans import data_queries, lifecycle
from riskmart.session import run_folder
from riskmart.sources import decisions, tables


def rows(spark, values):
    return spark.createDataFrame(values, "month string, n int, slot string")


def held(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path).collect())


@pytest.fixture
def path(spark):
    place = run_folder(spark, "table")
    tables.write_table(rows(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x"), ("c", 4, "x")]), place, ["month"])
    return place


def test_partitions_are_replaced(spark, path):
    tables.write_table(rows(spark, [("b", 9, "z")]), path, ["month"])
    assert held(spark, path) == [("a", 1, "x"), ("a", 2, "y"), ("b", 9, "z"), ("c", 4, "x")]
    tables.write_table(rows(spark, [("a", 5, "x")]), path, ["month"], within={"month": ("a", "b")})
    assert held(spark, path) == [("a", 5, "x"), ("c", 4, "x")]
    tables.write_table(rows(spark, []), path, ["month"], within={"month": ("a", "z")})
    assert held(spark, path) == [] and tables.read_table(spark, path).columns == ["month", "n", "slot"]


def test_a_range_over_several_columns(spark):
    place = run_folder(spark, "table")
    tables.write_table(rows(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x")]), place, ["slot", "month"])
    tables.write_table(rows(spark, [("b", 7, "y")]), place, ["slot", "month"], within={"month": ("a", "a"), "slot": ("x", "x")})
    assert held(spark, place) == [("a", 2, "y"), ("b", 3, "x"), ("b", 7, "y")]


def test_a_failing_write_leaves_the_old_months(spark, path):
    before = held(spark, path)
    bad = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") < 2000, "a").otherwise("b").alias("month"),
        F.when(F.col("id") < 3990, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("lost"))).alias("n"), F.lit("x").alias("slot"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(bad, path, ["month"], within={"month": ("a", "z")})
    assert held(spark, path) == before


def test_a_table_written_over_itself(spark, path):
    tables.write_table(tables.read_table(spark, path).withColumn("n", F.col("n") * 10), path, ["month"])
    assert held(spark, path) == [("a", 10, "x"), ("a", 20, "y"), ("b", 30, "x"), ("c", 40, "x")]


def test_the_plan_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch
    df = spark.range(500).select(F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("month"), "id").mapInPandas(count, "month string, id long")
    place = run_folder(spark, "once")
    tables.write_table(df, place, ["month"], rebalance=False)
    assert seen.value == 500 and tables.read_table(spark, place).count() == 500


def test_a_manifest_whose_writer_broke_off(spark, path):
    before = held(spark, path)
    number, _ = tables.manifest(spark, path)
    assert tables.put_if_absent(spark, os.path.join(path, tables.MANIFESTS, f"{number + 1:09d}.json"), '{"live": ["mon')
    assert held(spark, path) == before
    tables.write_table(rows(spark, [("b", 8, "x")]), path, ["month"])
    assert ("b", 8, "x") in held(spark, path) and len(held(spark, path)) == 4


def test_sessions_that_write_at_once_lose_nothing(spark):
    place = run_folder(spark, "shared")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: tables.write_table(rows(spark, [(f"m{i}", i, "x")]), place, ["month"], rebalance=False), range(8)))
    assert held(spark, place) == [(f"m{i}", i, "x") for i in range(8)]


def entry(slot, month, version, auc):
    return dict(zip(lifecycle.NAMES, (slot, month, version, "logistic_regression", month, auc, 0.5, "why", auc, None, None)))


def test_decisions_are_added_never_lost(spark):
    root = run_folder(spark, "log")
    assert decisions.latest(spark, root, lifecycle.VERSIONS).count() == 0
    month = date(2000, 1, 1)
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: decisions.append(spark, root, f"s{i % 2}", month, entry(f"s{i % 2}", month, f"v{i}", i / 10)), range(8)))
    assert sorted(numbers) == [1, 1, 2, 2, 3, 3, 4, 4]
    decisions.append(spark, root, "s0", month, entry("s0", month, "last", 0.9))
    # a session that broke off while writing
    assert tables.put_if_absent(spark, os.path.join(root, decisions.LOG, f"s1_{month}", "000009.json"), '{"slot": "s1", "trained')
    got = {r["slot"]: r for r in decisions.latest(spark, root, lifecycle.VERSIONS).collect()}
    assert set(got) == {"s0", "s1"} and got["s0"]["version"] == "last" and got["s0"]["trained_on"] == month and got["s0"]["oot_auc"] == 0.9


def test_a_break_between_log_and_tables(spark, monkeypatch):
    cycle = lifecycle.Cycle(spark, run_folder(spark, "broken"), Policy())
    row = tuple(entry("model_2", date(2000, 1, 1), "v1", 0.7)[n] for n in lifecycle.NAMES)
    monkeypatch.setattr(lifecycle, "write_table", lambda *a, **k: (_ for _ in ()).throw(IOError("gone")))
    with pytest.raises(IOError):
        cycle.record(row)
    monkeypatch.undo()
    assert cycle.champion("model_2", date(2000, 2, 1)) == "v1"
    second = tuple(entry("model_2", date(2000, 3, 1), "v2", 0.8)[n] for n in lifecycle.NAMES)
    cycle.record(second)
    assert {r["version"] for r in cycle.table("registry_versions").collect()} == {"v1", "v2"} and cycle.table("registry_events").count() == 2


def test_a_month_scored_keeps_the_others(spark):
    """A loan scored in March that starts in January leaves January's predictions as they are, and is decided in March."""
    apps = [(f"L{i}", f"C{i}", date(2000, 1, 1), date(2000, 1, 1), 1, float(i)) for i in range(5)]
    apps += [(f"M{i}", f"D{i}", date(2000, 3, 1) if i else date(2000, 1, 1), date(2000, 3, 1), i % 2, float(i)) for i in range(4)]
    features = spark.createDataFrame(apps, "loan_id string, Customer_ID string, snapshot_date date, run_month date, has_clickstream int, f double")
    cycle = lifecycle.Cycle(spark, run_folder(spark, "months"), replace(Policy(), go_live=date(2000, 1, 1)))
    for slot in ("model_1", "model_2"):
        cycle.record(tuple(entry(slot, date(1999, 1, 1), f"{slot}_v", 0.7)[n] for n in lifecycle.NAMES))
        model = models.Fitted(logistic.NAME, ["f"], 0.1, [0.0], [0.2], value=[0.2])
        cycle.loaded[f"{slot}_v"] = lifecycle.Live(slot, f"{slot}_v", logistic.NAME, model, ["f"], 0.5, [], None, None, None)

    def counts(name):
        return {tuple(r) for r in cycle.table(name).groupBy("run_month", "routed_to" if name == "production" else "model_slot").count().collect()}
    january, march = date(2000, 1, 1), date(2000, 3, 1)
    for month in (january, march, march):
        lifecycle.score_month(cycle, month, features)
        assert {(january, "model_1", 5), (january, "model_2", 5)} <= counts("predictions") and (january, "model_1", 5) in counts("production")
    assert counts("predictions") == {(january, "model_1", 5), (january, "model_2", 5), (march, "model_1", 2), (march, "model_2", 4)}
    assert counts("production") == {(january, "model_1", 5), (march, "model_1", 2), (march, "model_2", 2)}
    # a slot without applicants has no rows any more
    lifecycle.score_month(cycle, march, features.withColumn("has_clickstream", F.lit(0)))
    assert counts("predictions") == {(january, "model_1", 5), (january, "model_2", 5), (march, "model_2", 4)}
    assert counts("production") == {(january, "model_1", 5), (march, "model_2", 4)}
    assert {str(r[0]) for r in cycle.table("predictions").where("run_month = date '2000-03-01'").select("scored_on").collect()} == {"2000-03-01"}


def test_rows_of_several_writes_are_derived_once(spark, sf, monkeypatch):
    plans, write = [], tables.write_table

    def seen(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **kwargs)
    monkeypatch.setattr(tables, "write_table", seen)
    data_queries.idempotent_overwrite(spark, sf).collect()
    assert len(plans) == 3 and not any("Join" in p for p in plans)
