"""Queries on the label store, the feature store and the populations drawn from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.config import Policy
from riskmart.operators import conform, gold, populations, splits
from riskmart.plans.catalog import part, query
from riskmart.plans.data_queries import rnd, tidy
from riskmart.plans.views import view

POLICY = Policy()
KEYS = "loan_id, Customer_ID, snapshot_date"


def loans(spark, sf):
    return conform.loan_daily(view(spark, sf, "v_loan_daily"))


def financials(spark, sf):
    return conform.financials(view(spark, sf, "v_financials"))


def attributes(spark, sf):
    return conform.attributes(view(spark, sf, "v_attributes"))


def features(spark, sf, among=None):
    """The feature store, or its rows for the loans of ``among``."""
    clicks = conform.clickstream(view(spark, sf, "v_click_months"))
    rows = loans(spark, sf)
    if among is not None:
        rows = rows.join(among.select("loan_id"), ["loan_id"], "left_semi")
    return gold.features(rows, attributes(spark, sf), financials(spark, sf), clicks)


def labels(spark, sf):
    return gold.labels(loans(spark, sf), POLICY.label_dpd, POLICY.label_mob)


part("g_labels", """
select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def, snapshot_date
from s_loan_daily where mob = 6""")
part("g_apps", """
select loan_id, Customer_ID, loan_start_date as snapshot_date, loan_amt, tenure, snapshot_date as run_month
from s_loan_daily where mob = 0""")
part("g_base", """
select p.*, a.Age, a.Occupation, f.* exclude (Customer_ID, snapshot_date)
from g_apps p left join s_attributes a on a.Customer_ID = p.Customer_ID and a.snapshot_date = p.run_month
left join s_financials f on f.Customer_ID = p.Customer_ID and f.snapshot_date = p.run_month""")


@query("default_rate", """
select snapshot_date, count(*) as n_loans, cast(sum(label) as bigint) as n_bad, round(avg(label), 6) as default_rate
from g_labels group by 1""")
def default_rate(spark, sf):
    """Default rate per label month."""
    return labels(spark, sf).groupBy("snapshot_date").agg(
        F.count("*").alias("n_loans"), F.sum("label").alias("n_bad"), F.round(F.avg("label"), 6).alias("default_rate")
    )


@query("label_store", "select * from g_labels")
def label_store(spark, sf):
    return labels(spark, sf)


@query("applications", f"select {KEYS}, {rnd('loan_amt')}, tenure, run_month from g_apps")
def applications(spark, sf):
    return tidy(gold.applications(loans(spark, sf)))


_BASE_FLOATS = ["loan_amt", *[c for c, t in C.FINANCIAL_TYPES.items() if t == "float"]]
_BASE_OTHERS = ["tenure", "run_month", "Age", "Occupation", *[c for c, t in C.FINANCIAL_TYPES.items() if t == "int"],
                "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Type_of_Loan", "Credit_History_Age_months"]


@query("feature_base_join", f"select {KEYS}, {', '.join(_BASE_OTHERS)}, {', '.join(rnd(c) for c in _BASE_FLOATS)} from g_base")
def feature_base_join(spark, sf):
    apps = gold.applications(loans(spark, sf))
    return tidy(gold.application_base(apps, attributes(spark, sf), financials(spark, sf)))


def _one_hot_sql() -> str:
    return ", ".join(
        [f"case when Occupation = '{o}' then 1 else 0 end as occupation_{C.slug(o)}" for o in C.OCCUPATIONS]
        + ["case when Occupation is null then 1 else 0 end as occupation_unknown"])


def _has(t: str) -> str:
    return f"case when list_contains(string_split(Type_of_Loan, ','), '{t}') then 1 else 0 end"


def _multi_hot_sql() -> str:
    total = " + ".join(_has(t) for t in C.LOAN_TYPES)
    return ", ".join([f"{_has(t)} as has_{C.slug(t)}" for t in C.LOAN_TYPES] + [f"{total} as num_loan_types"])


_ORDINAL_SQL = """
case Credit_Mix when 'Bad' then 0 when 'Standard' then 1 when 'Good' then 2 end as credit_mix_ordinal,
case when Payment_of_Min_Amount = 'Yes' then 1 else 0 end as min_payment_yes,
case when Payment_of_Min_Amount = 'No' then 1 else 0 end as min_payment_no,
case when Payment_of_Min_Amount = 'NM' then 1 else 0 end as min_payment_nm,
case when Payment_Behaviour like 'High%' then 1 when Payment_Behaviour like 'Low%' then 0 end as spend_level_high,
case when Payment_Behaviour like '%_Small_%' then 0 when Payment_Behaviour like '%_Medium_%' then 1
     when Payment_Behaviour like '%_Large_%' then 2 end as payment_value_ordinal"""


def _ratio(top: str, bottom: str, name: str) -> str:
    return rnd(f"cast(cast({top} as double) / nullif(cast({bottom} as double), 0) as float)", name)


_RATIO_SQL = ", ".join([
    _ratio("Outstanding_Debt", "Annual_Income", "debt_to_annual_income"),
    _ratio("Total_EMI_per_month", "Monthly_Inhand_Salary", "emi_to_monthly_salary"),
    _ratio("Amount_invested_monthly", "Monthly_Inhand_Salary", "invested_to_monthly_salary"),
    _ratio("Monthly_Balance", "Monthly_Inhand_Salary", "balance_to_monthly_salary"),
    rnd("case when Num_of_Loan > 0 then cast(cast(Num_of_Delayed_Payment as double) / Num_of_Loan as float) end", "delayed_payments_per_loan"),
])


@query("one_hot_fixed", f"select Customer_ID, snapshot_date, {_one_hot_sql()} from s_attributes")
def one_hot_fixed(spark, sf):
    return attributes(spark, sf).select("Customer_ID", "snapshot_date", *gold.occupation_columns())


@query("multi_hot_list", f"select Customer_ID, snapshot_date, {_multi_hot_sql()} from s_financials")
def multi_hot_list(spark, sf):
    return financials(spark, sf).select("Customer_ID", "snapshot_date", *gold.loan_type_columns())


@query("ordinal_encode", f"select Customer_ID, snapshot_date, {_ORDINAL_SQL} from s_financials")
def ordinal_encode(spark, sf):
    return financials(spark, sf).select("Customer_ID", "snapshot_date", *gold.behaviour_columns())


@query("affordability_ratios", f"select Customer_ID, snapshot_date, {_RATIO_SQL} from s_financials")
def affordability_ratios(spark, sf):
    return tidy(financials(spark, sf).select("Customer_ID", "snapshot_date", *gold.ratio_columns()))


@query("pit_clickstream", """
select a.Customer_ID, a.snapshot_date, """ + ", ".join(rnd(f"cast(avg(c.fe_{i}) as float)", f"fe_{i}_avg") for i in range(1, 6)) + """,
       cast(count(distinct c.snapshot_date) as int) as clickstream_months_observed,
       case when count(c.snapshot_date) > 0 then 1 else 0 end as has_clickstream
from v_click_apps a left join v_clickstream c on c.Customer_ID = a.Customer_ID and c.snapshot_date <= a.snapshot_date
group by 1, 2""")
def pit_clickstream(spark, sf):
    columns = [f"fe_{i}" for i in range(1, 6)]
    apps = view(spark, sf, "v_click_apps")
    history = conform.one_per(view(spark, sf, "v_clickstream"), ["Customer_ID", "snapshot_date"], columns)
    past = gold.click_history(history, apps, columns, at="snapshot_date")
    joined = apps.join(past, ["Customer_ID", "snapshot_date"], "left")
    return tidy(joined.select("Customer_ID", "snapshot_date", *gold.history_columns(columns)))


part("g_clicks", """
select m.Customer_ID, m.run_month, """ + ", ".join(f"cast(avg(c.{f}) as float) as {f}_avg" for f in C.CLICK_COLUMNS) + """,
       cast(count(distinct c.snapshot_date) as int) as observed
from (select distinct Customer_ID, run_month from g_apps) m
left join s_click_months c on c.Customer_ID = m.Customer_ID and c.snapshot_date <= m.run_month
group by 1, 2""")
_CLICK_SQL = "case when observed > 0 then 1 else 0 end as has_clickstream, observed as clickstream_months_observed"
part("g_features", f"""
select {KEYS.replace('Customer_ID', 'b.Customer_ID')}, {', '.join(rnd(c) if c in _BASE_FLOATS else c for c in ['loan_amt', 'tenure', *C.NUMERIC_FEATURES])}, {_RATIO_SQL},
       {_one_hot_sql()}, {_multi_hot_sql()}, {_ORDINAL_SQL}, {_CLICK_SQL}, {', '.join(rnd(f'{c}_avg') for c in C.CLICK_COLUMNS)}
from g_base b join g_clicks c on b.Customer_ID = c.Customer_ID and b.run_month = c.run_month""")


@query("feature_store", "select * from g_features")
def feature_store(spark, sf):
    return tidy(features(spark, sf))


@query("run_summary", """
select (select count(*) from g_labels) as n_labels, (select count(*) from g_labels where label = 1) as n_bad,
       (select count(*) from g_labels where label = 0) as n_good, (select count(*) from g_apps) as n_features,
       (select count(*) from g_apps a join g_labels l using (loan_id)) as n_matured,
       (select count(*) from g_apps a join g_labels l using (loan_id)
        where l.snapshot_date <> cast(a.snapshot_date + interval 6 month as date)) as n_misaligned""")
def run_summary(spark, sf):
    return populations.run_summary(gold.applications(loans(spark, sf)), labels(spark, sf))


@query("label_alignment", """
select a.loan_id, a.snapshot_date, l.snapshot_date as label_date from g_apps a join g_labels l using (loan_id)
where l.snapshot_date <> cast(a.snapshot_date + interval 5 month as date)""")
def label_alignment(spark, sf):
    """Labels checked against a wrong maturity of five months, which none of them keeps."""
    found = populations.misaligned(gold.applications(loans(spark, sf)), labels(spark, sf), 5)
    return found.select("loan_id", "snapshot_date", "label_date")


@query("labelled_as_of", """
select a.loan_id, a.Customer_ID, a.snapshot_date, l.label, l.snapshot_date as label_date
from g_apps a join g_labels l using (loan_id)
where l.snapshot_date <= date '1998-06-01' and a.snapshot_date <= date '1998-06-01'""")
def labelled_as_of(spark, sf):
    known = populations.labelled(gold.applications(loans(spark, sf)), labels(spark, sf), "1998-06-01")
    return known.select(*C.KEYS, "label", "label_date")


@query("slot_population", """
select snapshot_date, 'model_1' as slot, count(*) as n_rows from g_features where has_clickstream = 1 group by 1
union all select snapshot_date, 'model_2' as slot, count(*) as n_rows from g_features group by 1""")
def slot_population(spark, sf):
    store = features(spark, sf)
    parts = [
        populations.slot_population(store, kind).groupBy("snapshot_date").agg(F.count("*").alias("n_rows"))
        .select("snapshot_date", F.lit(slot).alias("slot"), "n_rows")
        for slot, kind in POLICY.feature_sets.items()
    ]
    return parts[0].unionByName(parts[1])


@query("core_projection", "select loan_id, " + "* exclude (loan_id, Customer_ID, snapshot_date, "
       + ", ".join(C.clickstream_features()) + ") from g_features")
def core_projection(spark, sf):
    store = features(spark, sf)
    return tidy(store.select("loan_id", *populations.feature_columns(store, "core")))


part("g_month_roles", """
select snapshot_date, case when pos > n - 2 then 'oot'
       when pos > n - 2 - greatest(1, cast(round_even((n - 2) * 0.2, 0) as int)) then 'test' else 'train' end as role
from (select snapshot_date, row_number() over (order by snapshot_date) as pos, count(*) over () as n
      from (select distinct snapshot_date from g_apps))""")


@query("time_split", """
select snapshot_date, role, count(*) as n_rows, round(sum(loan_amt), 2) as amount
from (select snapshot_date, round(cast(loan_amt as double), 2) as loan_amt from g_apps) join g_month_roles using (snapshot_date) group by 1, 2""")
def time_split(spark, sf):
    split = splits.time_split(gold.applications(loans(spark, sf)), POLICY)
    amount = F.sum(F.round(F.col("loan_amt").cast("double"), 2))
    return split.groupBy("snapshot_date", "role").agg(F.count("*").alias("n_rows"), F.round(amount, 2).alias("amount"))


@query("walk_forward_folds", """
with v as (select snapshot_date as m, row_number() over (order by snapshot_date) as fold
           from (select distinct snapshot_date from g_apps join g_month_roles using (snapshot_date) where role = 'train'
                 order by snapshot_date desc limit 3))
select cast(fold as int) as fold, case when a.snapshot_date < m then 'fit' else 'validate' end as part, a.snapshot_date, count(*) as n_rows
from g_apps a join g_month_roles r using (snapshot_date) join v on a.snapshot_date <= v.m where r.role = 'train' group by 1, 2, 3""")
def walk_forward_folds(spark, sf):
    split = splits.time_split(gold.applications(loans(spark, sf)), POLICY).withColumnRenamed("role", "part")
    train = split.where("part = 'train'").drop("part")
    folds = splits.walk_forward(train, POLICY.cv_folds).withColumnRenamed("role", "part")
    return folds.groupBy("fold", "part", "snapshot_date").agg(F.count("*").alias("n_rows"))
