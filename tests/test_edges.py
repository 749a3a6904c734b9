"""Hand-made edge rows per operator."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.config import Policy
from riskmart.functions import cleaning as clean
from riskmart.functions import status as light
from riskmart.operators import conform, drift, gold, metrics, populations, routing, splits
from riskmart.operators.registry import better_algorithm

NAN = float("nan")


def values(spark, kind, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


def test_numeric(spark):
    text = ["52312.68_", "__10000__", "_", "", " 7 ", "abc", None, "11.0"]
    got = values(spark, "string", text, clean.numeric("v", "double"))
    assert got == [52312.68, 10000.0, None, None, 7.0, None, None, 11.0]
    assert values(spark, "string", ["11.0", "1_000", "nan", "1e30"], clean.numeric("v", "int")) == [11, 1000, None, None]


def test_within(spark):
    assert values(spark, "double", [14.0, 13.0, 100.0, 101.0, -500.0, None, NAN], clean.within("v", 14, 100)) == [
        14, None, 100, None, None, None, None]


def test_income_cap(spark):
    s = 1234.56
    columns = ["Customer_ID", "Annual_Income", "Monthly_Inhand_Salary"]
    rest = {c: "1" for c in C.FINANCIAL_TYPES if c not in columns} | {
        c: None for c in ("Credit_History_Age", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Type_of_Loan")}
    incomes = [(str(36 * s), str(s)), (str(36 * s + 1), str(s)), ("5", None)]
    schema = "Customer_ID string, Annual_Income string, Monthly_Inhand_Salary string, snapshot_date string, " + ", ".join(
        f"{c} string" for c in rest)
    rows = [(str(i), a, b, "2024-01-01", *rest.values()) for i, (a, b) in enumerate(incomes)]
    got = conform.financials(spark.createDataFrame(rows, schema)).orderBy("Customer_ID").collect()
    assert got[0]["Annual_Income"] == pytest.approx(36 * s, rel=1e-6)
    assert [r["Annual_Income"] for r in got[1:]] == [None, None]


def test_text_rules(spark):
    assert values(spark, "string", ["10 Years and 9 Months", "5 Years", "9 Months", "NA", None, "9999999999 Years"],
                  clean.span_in_months("v")) == [129, 60, None, None, None, None]
    assert values(spark, "string", ["A, and B", "A, B, and C", "and A", None], clean.comma_list("v")) == ["A,B", "A,B,C", "A", None]
    ids = ["123-45-6789", " 123-45-6789 ", "#F%$D@*&8", None]
    assert values(spark, "string", ids, clean.matches("v", C.ID_PATTERN)) == [True, True, False, False]


def test_days_past_due(spark):
    rows = [("a", 0.0, 100.0), ("b", 100.0, 100.0), ("c", 250.0, 100.0), ("d", 50.0, 0.0), ("e", None, 100.0)]
    df = spark.createDataFrame(rows, "loan_id string, overdue_amt double, due_amt double").select(
        "*", F.lit(6).alias("installment_num"), F.lit("2024-03-01").cast("date").alias("snapshot_date"), F.lit("x").alias("Customer_ID"))
    silver = conform.loan_daily(df)
    assert [r["dpd"] for r in silver.orderBy("loan_id").collect()] == [0, 29, 91, None, 0]
    assert [r["label"] for r in gold.labels(silver).orderBy("loan_id").collect()] == [0, 0, 1, 0, 0]


def test_unreadable_instalment_becomes_month_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "2")], "loan_id string, installment_num string").select(
        "*", F.lit(0.0).alias("overdue_amt"), F.lit(1.0).alias("due_amt"), F.lit("2024-03-01").alias("snapshot_date"))
    assert [r["mob"] for r in conform.loan_daily(df).orderBy("loan_id").collect()] == [0, 2]
    assert conform.zero_filled_mob(df).first()["n_zero_filled"] == 1


def test_loan_types(spark):
    df = spark.createDataFrame([(0, "Student Loan,Mortgage Loan,Student Loan"), (1, None)], "i int, Type_of_Loan string")
    got = df.select("i", *gold.loan_type_columns()).orderBy("i").collect()
    assert [r["num_loan_types"] for r in got] == [2, 0]
    assert got[0]["has_student_loan"] == 1 and got[1]["has_student_loan"] == 0


def test_point_in_time(spark):
    clicks = spark.createDataFrame(
        [("late", date(2024, 2, 1), 5), ("same", date(2024, 1, 1), 4), ("null", date(2023, 12, 1), None)],
        "Customer_ID string, snapshot_date date, fe_1 int")
    asked = spark.createDataFrame([(c, date(2024, 1, 1)) for c in ("late", "same", "null", "none")], "Customer_ID string, run_month date")
    got = gold.click_history(clicks, asked, ["fe_1"]).collect()
    assert {r["Customer_ID"]: (r["clickstream_months_observed"], r["fe_1_avg"]) for r in got} == {
        "late": (0, None), "same": (1, 4.0), "null": (1, None), "none": (0, None)}


@pytest.mark.parametrize("pairs, auc, cutoff", [
    ([(0.5, 0), (0.5, 1), (0.5, 0)], 0.5, 1.0),
    ([(0.1, 0), (0.9, 1)], 1.0, 0.9),
    ([(0.9, 0), (0.1, 1)], 0.0, 1.0),
    ([(0.9, 1), (0.1, 1)], None, 1.0),
])
def test_rank_metrics(spark, pairs, auc, cutoff):
    row = metrics.rank_metrics(spark.createDataFrame(pairs, "score double, label int"), []).first()
    assert (row["auc"], row["ks_cutoff"]) == (auc, cutoff)


def edges_of(spark, xs):
    df = spark.createDataFrame([("v", float(x) if x is not None else None) for x in xs], "variable string, value double")
    return [r["edge"] for r in drift.decile_edges(df, ["variable"]).orderBy("edge_no").collect()]


def test_bins(spark):
    assert edges_of(spark, [3, 3, 3]) == []
    assert edges_of(spark, [0] * 5 + [1] * 6) == [0.5]
    assert edges_of(spark, [None, None]) == []
    assert edges_of(spark, [0, 1, 2] * 10) == [1.0]


def test_lights(spark):
    assert values(spark, "double", [0.1, 0.11, 0.25, 0.26, None], light.high_is_bad(F.col("v"), (0.1, 0.25))) == [
        "green", "amber", "amber", "red", "info"]


def test_live_intervals(spark):
    reg = spark.createDataFrame([("s", "v1", date(2024, 1, 1), date(2024, 1, 1), date(2024, 3, 1)), ("s", "v0", date(2023, 1, 1), None, None)],
                                "slot string, version string, trained_on date, promoted_at date, retired_at date")
    days = spark.createDataFrame([("s", date(2024, 1, 1)), ("s", date(2024, 3, 1))], "slot string, d date")
    at = {r["d"] for r in populations.live_versions(days, reg, "d").collect()}
    before = {r["d"] for r in populations.live_versions(days, reg, "d", True).collect()}
    assert at == {date(2024, 1, 1)} and before == {date(2024, 3, 1)}


@pytest.mark.parametrize("n_months, roles", [(7, (4, 1)), (18, (13, 3))])
def test_month_split(spark, n_months, roles):
    months = spark.range(n_months).select(F.add_months(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("snapshot_date"))
    split = splits.time_split(months, Policy())
    got = {r["role"]: r["count"] for r in split.groupBy("role").count().collect()}
    assert (got["train"], got["test"], got["oot"]) == (*roles, 2)
    assert splits.require_train_months(split, Policy()) == roles[0]


def test_too_few_train_months(spark):
    months = spark.range(6).select(F.add_months(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("snapshot_date"))
    with pytest.raises(ValueError):
        splits.require_train_months(splits.time_split(months, Policy()), Policy())


def test_folds_never_look_ahead(spark):
    months = spark.range(8).select(F.add_months(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("snapshot_date"))
    folds = splits.walk_forward(months, 3).groupBy("fold").agg(
        F.max(F.when(F.col("role") == "fit", F.col("snapshot_date"))).alias("f"), F.min(F.when(F.col("role") == "validate", F.col("snapshot_date"))).alias("v"))
    assert all(r["f"] < r["v"] for r in folds.collect()) and folds.count() == 3


def test_routing(spark):
    p = spark.createDataFrame([("a", "model_1", 1), ("a", "model_2", 2), ("b", "model_2", 3)], "loan_id string, model_slot string, n int")
    got = routing.route(p.withColumn("snapshot_date", F.lit("2024-01-01").cast("date")))
    assert {(r["loan_id"], r["routed_to"], r["n"]) for r in got.collect()} == {("a", "model_1", 1), ("b", "model_2", 3)}
    assert routing.routed_twice(got).first()["n_repeated"] == 0


def test_algorithm_tie(spark):
    df = spark.createDataFrame([("x", "plain", 0.80), ("x", "rich", 0.804), ("y", "plain", 0.8), ("y", "rich", 0.81)], "k string, algorithm string, test_auc double")
    got = {r["k"]: r["algorithm"] for r in better_algorithm(df, ["k"], "plain", 0.005).collect()}
    assert got == {"x": "plain", "y": "rich"}


def test_cutoff_of_nothing(spark):
    df = spark.createDataFrame([(0.2, 0, 0.5), (0.3, 1, 0.5)], "score double, label int, threshold double")
    row = metrics.cutoff_summary(df, []).first()
    assert row["precision"] is None and row["recall"] == 0.0 and row["f1"] is None and row["bad_rate_approved"] == 0.5


def test_shared_ids(spark):
    df = spark.createDataFrame([("1", "a", 1), ("1", "b", 1), ("1", "a", 1), ("2", "c", 1), (None, "d", 0), (None, "e", 0)],
                               "SSN string, Customer_ID string, ssn_valid int")
    assert tuple(conform.shared_ids(df).first()) == (1, 2)
