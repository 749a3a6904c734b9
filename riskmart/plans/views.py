"""Loan-domain views over the test tables.

Each view is one SELECT that both engines read alike; only the month shift is spelled differently. The same
text feeds the Spark query and the SQL it is checked against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ["customer", "orders", "lineitem", "events", "documents", "labels"]

# Months added to a date, in each dialect.
SHIFT = {
    "spark": "add_months({0}, cast({1} as int))",
    "duckdb": "cast({0} + to_months(cast({1} as int)) as date)",
}

# name -> SELECT; {name} is another view or a base table, [[date|n]] a date moved by n months.
TEXT = {
    # repayments: one row per (loan, instalment). Lines are reduced before they meet their order.
    "v_loan_daily": """
select cast(l.l_orderkey as string) as loan_id, cast(o.o_custkey as string) as Customer_ID,
       o.start as loan_start_date, 10 as tenure, l.l_linenumber - 1 as installment_num, l.price as loan_amt,
       case when l.l_linenumber = 1 then 0 else l.qty * 100 end as due_amt,
       case when l.l_linenumber = 1 then 0 else greatest(l.over, 0) end as overdue_amt,
       [[o.start|l.l_linenumber - 1]] as snapshot_date
from (select l_orderkey, l_linenumber, max(l_extendedprice) as price, max(l_quantity) as qty,
             max(l_extendedprice * (l_discount - l_tax)) as over
      from {lineitem} group by l_orderkey, l_linenumber) l
join (select o_orderkey, o_custkey, cast(date_trunc('month', o_orderdate) as date) as start from {orders}) o
  on l.l_orderkey = o.o_orderkey""",
    "v_customer_months": """
select c.c_custkey as k, c.c_name, c.c_mktsegment, o.snapshot_date
from {customer} c
join (select distinct o_custkey, cast(date_trunc('month', o_orderdate) as date) as snapshot_date from {orders}) o
  on c.c_custkey = o.o_custkey""",
    "v_attributes": """
select cast(k as string) as Customer_ID,
       case when k % 13 = 0 then concat('  ', c_name, ' ') when k % 37 = 0 then '   ' else c_name end as Name,
       case when k % 17 = 0 then '#F%$D@*&8'
            else concat(lpad(cast(k % 500 as string), 3, '0'), '-', cast(k % 10 + 10 as string), '-0001') end as SSN,
       case when k % 23 = 0 then '-500' when k % 41 = 0 then '8678'
            when k % 7 = 0 then concat(cast(14 + k % 43 as string), '_') else cast(14 + k % 43 as string) end as Age,
       case when k % 11 = 0 then '_______' when c_mktsegment = 'AUTOMOBILE' then 'Mechanic'
            when c_mktsegment = 'BUILDING' then 'Architect' when c_mktsegment = 'FURNITURE' then 'Manager'
            when c_mktsegment = 'HOUSEHOLD' then 'Teacher' else 'Media_Manager' end as Occupation,
       cast(snapshot_date as string) as snapshot_date
from {v_customer_months}""",
    "v_financials": """
select cast(k as string) as Customer_ID,
       concat(cast(sal * 12 * (case when k % 29 = 0 then 50 else 1 end) as string),
              case when k % 9 = 0 then '_' else '' end) as Annual_Income,
       case when k % 19 = 0 then '' else cast(sal as string) end as Monthly_Inhand_Salary,
       cast(k % 12 as string) as Num_Bank_Accounts,
       case when k % 43 = 0 then '1499' else cast(k % 11 as string) end as Num_Credit_Card,
       cast(1 + k % 34 as string) as Interest_Rate,
       case when k % 31 = 0 then '-100'
            else concat(cast(k % 6 as string), case when k % 14 = 0 then '_' else '' end) end as Num_of_Loan,
       cast(k % 60 - 5 as string) as Delay_from_due_date,
       case when k % 8 = 0 then '_' else cast(k % 28 as string) end as Num_of_Delayed_Payment,
       case when k % 10 = 0 then '_' else cast(k % 30 as string) end as Changed_Credit_Limit,
       cast(k % 17 as string) as Num_Credit_Inquiries,
       cast(100 + k * 13 % 4900 as string) as Outstanding_Debt,
       cast(20 + k % 30 as string) as Credit_Utilization_Ratio,
       cast(k * 7 % 9000 as string) as Total_EMI_per_month,
       case when k % 16 = 0 then '__10000__' else cast(k % 700 as string) end as Amount_invested_monthly,
       case when k % 47 = 0 then '__-333333333333333333333333333__' else cast(k % 900 - 50 as string) end as Monthly_Balance,
       case when k % 15 = 0 then 'NA' when k % 21 = 0 then '9 Months'
            else concat(cast(k % 33 as string), ' Years and ', cast(k % 12 as string), ' Months') end as Credit_History_Age,
       case k % 4 when 0 then 'Good' when 1 then 'Standard' when 2 then 'Bad' else '_' end as Credit_Mix,
       case k % 4 when 0 then 'Yes' when 1 then 'No' when 2 then 'NM' else '#' end as Payment_of_Min_Amount,
       case k % 7 when 0 then '!@9#%8' when 1 then 'Low_spent_Small_value_payments'
            when 2 then 'Low_spent_Medium_value_payments' when 3 then 'Low_spent_Large_value_payments'
            when 4 then 'High_spent_Small_value_payments' when 5 then 'High_spent_Medium_value_payments'
            else 'High_spent_Large_value_payments' end as Payment_Behaviour,
       case k % 6 when 0 then null when 1 then 'Auto Loan' when 2 then 'Auto Loan, and Payday Loan'
            when 3 then 'Student Loan, Mortgage Loan, and Student Loan' when 4 then 'Not Specified'
            else 'Credit-Builder Loan, Home Equity Loan, and Personal Loan' end as Type_of_Loan,
       cast(snapshot_date as string) as snapshot_date
from (select k, 1000 + k * 37 % 5000 as sal, snapshot_date from {v_customer_months}) b""",
    # the events cover one January, so here the day is the period
    "v_clickstream": """
select cast(user_id as string) as Customer_ID, cast(date_trunc('day', ts) as date) as snapshot_date,
       cast(sum(case when event_type = 'click' then 1 else 0 end) as int) as fe_1,
       cast(sum(case when event_type = 'view' then 1 else 0 end) as int) as fe_2,
       cast(sum(case when event_type = 'error' then 1 else 0 end) as int) as fe_3,
       cast(sum(case when event_type = 'purchase' then 1 else 0 end) as int) as fe_4,
       cast(sum(cast(floor(value) as int)) as int) as fe_5
from {events} where event_type <> 'signup' group by user_id, cast(date_trunc('day', ts) as date)""",
    "v_click_apps": """
select cast(user_id as string) as Customer_ID, cast(min(date_trunc('day', ts)) as date) as snapshot_date
from {events} where event_type = 'signup' group by user_id""",
    # raw monthly clickstream with twenty text columns: the days of the month laid out over 90 months
    "v_click_months": """
select Customer_ID, cast(month as string) as snapshot_date, %s
from (select cast(user_id as string) as Customer_ID, [[date '1995-01-01'|(day(ts) - 1) * 3]] as month,
             sum(cast(floor(value) as int)) as v, count(*) as n
      from {events} group by user_id, day(ts)) e""" % ", ".join(
        f"concat(cast((v * {i} + n) %% {40 + i} as string), case when n %% 5 = {i % 5} then '_' else '' end) as fe_{i}".replace("%%", "%")
        for i in range(1, 21)
    ),
    "v_scored": """
select l_orderkey as loan_id, l_linestatus as model_slot, l_linenumber as model_version,
       cast(date_trunc('month', l_shipdate) as date) as cohort_date,
       abs(l_discount) * 10 as score_tied, l_extendedprice / 110000.0 as score_cont,
       case when l_discount > l_tax then 1 else 0 end as label
from {lineitem}""",
    "v_doc_scored": """
select d.doc_id, d.lang, d.n_chars / 130000.0 as score, 1 - l.quality as label, l.toxic
from {documents} d join {labels} l on d.doc_id = l.doc_id""",
    # feature columns of the scored rows: plain, many missing, two-valued, constant, and one with a long tail
    "v_scored_features": """
select l_linestatus as model_slot, l_linenumber as model_version, cast(date_trunc('month', l_shipdate) as date) as cohort_date,
       l_extendedprice as amount, l_quantity as quantity,
       case when abs(l_tax) < 0.015 then null else l_tax end as tax,
       case when l_returnflag = 'R' then 1 else 0 end as returned, 7 as constant,
       case when l_quantity > 47 then l_extendedprice else 0 end as tail
from {lineitem}""",
    # one row per loan: score, label and features; the full model stops seeing click data in June 2000
    "v_loans": """
select l_orderkey as loan_id, cast(min(date_trunc('month', l_shipdate)) as date) as snapshot_date,
       max(case when l_linestatus = 'F' then abs(l_discount) * 8 + l_quantity / 1000 + l_extendedprice / 98765432.1 end) as score_1,
       max(case when l_linestatus = 'O' then abs(l_discount) * 6 + l_quantity / 500 + l_extendedprice / 87654321.9 end) as score_2,
       case when max(l_discount) > max(l_tax) then 1 else 0 end as label,
       max(l_extendedprice) as amount, max(l_quantity) as quantity,
       nullif(max(abs(l_tax)), 0.08) as tax, max(case when l_returnflag = 'R' then 1 else 0 end) as returned
from {lineitem} group by l_orderkey""",
    "v_predictions": """
select loan_id, snapshot_date, 'model_1' as model_slot, concat('model_1_v', cast(loan_id % 3 as string)) as model_version,
       1 as has_clickstream, score_1 as score, 0.62 as threshold,
       case when score_1 >= 0.62 then 'decline' else 'approve' end as decision, amount, quantity, tax, returned
from {v_loans} where score_1 is not null and snapshot_date < date '2000-06-01'
union all
select loan_id, snapshot_date, 'model_2' as model_slot, concat('model_2_v', cast(loan_id % 3 as string)) as model_version,
       case when score_1 is not null and snapshot_date < date '2000-06-01' then 1 else 0 end as has_clickstream,
       coalesce(score_2, score_1 * 0.9) as score, 0.55 as threshold,
       case when coalesce(score_2, score_1 * 0.9) >= 0.55 then 'decline' else 'approve' end as decision,
       amount, quantity, tax, returned
from {v_loans}""",
    "v_labels": """
select loan_id, label, [[snapshot_date|6]] as snapshot_date from {v_loans}""",
}


def _dialect(text: str, dialect: str) -> str:
    while "[[" in text:
        head, rest = text.split("[[", 1)
        inside, tail = rest.split("]]", 1)
        text = head + SHIFT[dialect].format(*inside.split("|")) + tail
    return text


def parents(name: str) -> list[str]:
    return [n for n in [*BASE, *TEXT] if "{" + n + "}" in TEXT.get(name, "")]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a view on it, as a lazy DataFrame."""
    if name not in TEXT:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {p: view(spark, sf_dir, p) for p in parents(name)}
    return spark.sql(_dialect(TEXT[name], "spark"), **inputs)


def duckdb_text(name: str) -> str:
    """The view's SELECT for DuckDB, naming the views it needs."""
    text = _dialect(TEXT[name], "duckdb")
    for p in parents(name):
        text = text.replace("{" + p + "}", p)
    return text
