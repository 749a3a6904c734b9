"""Queries on sources, calendar and silver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.config import Policy
from riskmart.functions import cleaning as clean
from riskmart.functions.dates import whole_months
from riskmart.operators import calendar, conform, gold
from riskmart.plans.catalog import part, query
from riskmart.plans.views import view
from riskmart.session import run_folder
from riskmart.sources import raw, tables

POLICY = Policy()


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floating columns as rounded doubles, for comparison with the check SQL."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.round(F.col(c).cast("double"), digits).alias(c) if kinds[c] in ("float", "double") else F.col(c)
        for c in df.columns
    ])


def rnd(expr: str, name: str | None = None, digits: int = 4) -> str:
    return f"round(cast({expr} as double), {digits}) as {name or expr}"


def num(c: str, kind: str) -> str:
    """Check SQL of the numeric cleaner."""
    bare = f"try_cast(nullif(trim(replace({c}, '_', '')), '') as double)"
    return f"cast(trunc({bare}) as int)" if kind == "int" else f"cast({bare} as float)"


# --- sources ------------------------------------------------------------------------------------------------

ATTRIBUTE_COLUMNS = "Customer_ID, Name, SSN, Age, Occupation, snapshot_date"


def _csv_of(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = run_folder(spark, name)
    df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("bronze_scan", f"select {ATTRIBUTE_COLUMNS} from v_attributes")
def bronze_scan(spark, sf):
    return raw.read_raw(spark, _csv_of(spark, view(spark, sf, "v_attributes"), "raw"))


@query("bronze_month_counts", "select snapshot_date, count(*) as n_rows from v_financials group by 1")
def bronze_month_counts(spark, sf):
    source = raw.read_raw(spark, _csv_of(spark, view(spark, sf, "v_financials"), "raw"))
    return raw.ingest(source, run_folder(spark, "bronze"))


@query("bronze_outside_calendar", """
select count(*) as n_rows, count(*) filter (where not coalesce(regexp_matches(snapshot_date, '^\\d{4}-\\d{2}-01$'), false)) as n_outside
from (select strftime(o_orderdate, '%Y-%m-%d') as snapshot_date from orders)""")
def bronze_outside_calendar(spark, sf):
    orders = view(spark, sf, "orders")
    return calendar.outside_calendar(orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("snapshot_date")))


@query("gold_range_scan", """
select snapshot_date, count(*) as n_rows, cast(sum(label) as bigint) as n_bad from g_labels
where snapshot_date between date '1996-03-01' and date '1998-06-01' group by 1""")
def gold_range_scan(spark, sf):
    path = run_folder(spark, "labels")
    tables.write_table(gold.labels(conform.loan_daily(view(spark, sf, "v_loan_daily"))), path, ["snapshot_date"])
    stored = tables.read_table(spark, path, "1996-03-01", "1998-06-01", ["snapshot_date", "label"])
    return stored.groupBy("snapshot_date").agg(F.count("*").alias("n_rows"), F.sum("label").alias("n_bad"))


@query("idempotent_overwrite", "select snapshot_date, count(*) as n_rows, count(distinct loan_id) as n_loans from v_loan_daily group by 1")
def idempotent_overwrite(spark, sf):
    """A table written twice, and one month written a third time, holds every row once."""
    path = run_folder(spark, "loans")
    # read by three writes
    loans = tables.stored(view(spark, sf, "v_loan_daily"), "loan_rows")
    tables.write_table(loans, path, ["snapshot_date"])
    tables.write_table(loans, path, ["snapshot_date"])
    tables.write_table(loans.where("snapshot_date = date '1997-01-01'"), path, ["snapshot_date"])
    return tables.read_table(spark, path).groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows"), F.countDistinct("loan_id").alias("n_loans")
    )


@query("monthly_rebuild", """
select run_month, snapshot_date, count(*) as n_rows from (
  select snapshot_date as run_month, loan_start_date as snapshot_date from v_loan_daily
  where mob_of(installment_num, loan_id) = 0 and snapshot_date <> date '1996-05-01') group by 1, 2""".replace(
    "mob_of(installment_num, loan_id)", "(case when cast(loan_id as bigint) % 50 = 1 then 0 else installment_num end)"))
def monthly_rebuild(spark, sf):
    """Applications of all months, then two months again of which one is empty now; unreadable instalment numbers give foreign start dates."""
    path = run_folder(spark, "applications")
    unread = F.when(F.col("loan_id").cast("long") % 50 == 1, F.lit("n/a")).otherwise(F.col("installment_num").cast("string"))
    apps = gold.applications(conform.loan_daily(view(spark, sf, "v_loan_daily").withColumn("installment_num", unread)))
    tables.write_table(apps, path, ["run_month"], within={"run_month": ("1990-01-01", "2010-01-01")})
    again = apps.where("run_month = date '1996-04-01'")
    tables.write_table(again, path, ["run_month"], within={"run_month": ("1996-04-01", "1996-05-01")})
    return tables.read_table(spark, path).groupBy("run_month", "snapshot_date").agg(F.count("*").alias("n_rows"))


CONTRACT_VIEWS = {
    "loan_daily": "v_loan_daily", "attributes": "v_attributes", "financials": "v_financials", "clickstream": "v_clickstream",
}


def _contract_sql() -> str:
    absent = {("clickstream", "fe_20")}
    lines = [
        f"select '{t}' as table_name, '{c}' as column_name, {int((t, c) not in absent)} as present, "
        + (f"(select count({c}) from {CONTRACT_VIEWS[t]})" if (t, c) not in absent else "cast(0 as bigint)") + " as n_filled"
        for t, columns in C.REQUIRED_COLUMNS.items() for c in columns
    ]
    return "select * from (" + " union all ".join(lines) + ")"


@query("source_contract", _contract_sql())
def source_contract(spark, sf):
    return raw.contract({t: view(spark, sf, v) for t, v in CONTRACT_VIEWS.items()})


# --- calendar -----------------------------------------------------------------------------------------------

def order_months(spark, sf) -> DataFrame:
    bounds = view(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )
    return calendar.months_between(bounds, "first", "last")


part("order_months", """
select cast(unnest(generate_series(date_trunc('month', a), b, interval 1 month)) as date) as snapshot_date
from (select min(o_orderdate) as a, max(o_orderdate) as b from orders)""")


@query("month_calendar", "select snapshot_date from order_months")
def month_calendar(spark, sf):
    return order_months(spark, sf)


@query("month_arith", """
select snapshot_date, cast(snapshot_date + interval 6 month as date) as label_month,
       cast(snapshot_date - interval 6 month as date) as cohort_month,
       cast(date_diff('month', date '1995-03-01', snapshot_date) as int) as since,
       count(o_orderkey) as n_orders
from order_months left join orders on cast(date_trunc('month', o_orderdate) as date) = snapshot_date group by 1""")
def month_arith(spark, sf):
    orders = view(spark, sf, "orders").groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("snapshot_date")
    ).agg(F.count("o_orderkey").alias("n"))
    month = F.col("snapshot_date")
    return order_months(spark, sf).join(orders, "snapshot_date", "left").select(
        month, F.add_months(month, 6).alias("label_month"), F.add_months(month, -6).alias("cohort_month"),
        whole_months(F.lit("1995-03-01").cast("date"), month).alias("since"),
        F.coalesce("n", F.lit(0)).alias("n_orders"),
    )


# Windows of the test calendar, shaped like the real ones (customer tables end before the loan table).
TEST_POLICY = Policy(
    pipeline_start=date(1995, 1, 1), pipeline_end=date(2001, 6, 1),
    feature_start=date(1995, 1, 1), feature_end=date(2000, 12, 1),
    go_live=date(1996, 3, 1),
)


@query("table_availability", "select t.table_name, m.snapshot_date, case when m.snapshot_date between t.a and t.b then 1 else 0 end as available"
       " from order_months m, (values "
       + ", ".join(f"('{t}', date '{a}', date '{b}')" for t, (a, b) in TEST_POLICY.table_windows().items())
       + ") t(table_name, a, b)")
def table_availability(spark, sf):
    return calendar.availability(order_months(spark, sf), TEST_POLICY.table_windows())


@query("retrain_calendar", """
select snapshot_date, case when snapshot_date between date '1996-03-01' and date '2001-06-01'
       and date_diff('month', date '1996-03-01', snapshot_date) % 2 = 0 then 1 else 0 end as scheduled
from order_months""")
def retrain_calendar(spark, sf):
    return order_months(spark, sf).select(
        "snapshot_date", calendar.is_scheduled(F.col("snapshot_date"), TEST_POLICY).cast("int").alias("scheduled")
    )


# --- silver -------------------------------------------------------------------------------------------------

part("s_loan_daily", """
select *, case when overdue_amt > 0 then cast(date_diff('day', first_missed_date, snapshot_date) as int) else 0 end as dpd
from (select *, case when installments_missed > 0 then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
from (select loan_id, Customer_ID, loan_start_date, tenure, installment_num, cast(loan_amt as float) as loan_amt,
             cast(due_amt as float) as due_amt, cast(overdue_amt as float) as overdue_amt, snapshot_date,
             installment_num as mob,
             cast(coalesce(ceil(cast(cast(overdue_amt as float) as double) / nullif(cast(cast(due_amt as float) as double), 0)), 0) as int)
               as installments_missed
      from v_loan_daily))""")


@query("silver_loan_daily", f"""
select loan_id, Customer_ID, loan_start_date, tenure, installment_num, {rnd('loan_amt')}, {rnd('due_amt')},
       {rnd('overdue_amt')}, snapshot_date, mob, installments_missed, first_missed_date, dpd from s_loan_daily""")
def silver_loan_daily(spark, sf):
    return tidy(conform.loan_daily(view(spark, sf, "v_loan_daily")))


_K = "cast(loan_id as bigint) % 40"

part("v_loan_text", f"""
select loan_id, Customer_ID, cast(loan_start_date as varchar) as loan_start_date, cast(tenure as varchar) || '.0' as tenure,
  case when {_K} = 1 then cast(installment_num as varchar) || '.0' when {_K} = 2 then '  ' || installment_num || ' ' when {_K} = 3 then 'n/a'
       when {_K} = 4 then '' when {_K} = 5 then cast(installment_num as varchar) || '.9' else cast(installment_num as varchar) end as installment_num,
  cast(loan_amt as varchar) as loan_amt, case when {_K} = 6 then 'NaN' when {_K} = 7 then '' else cast(cast(trunc(due_amt) as int) as varchar) end as due_amt,
  case when {_K} = 8 then 'unpaid' else cast(cast(trunc(due_amt) as int) / 2 as varchar) end as paid_amt,
  case when {_K} = 9 then ' ' when {_K} = 10 then 'NaN' else cast(cast(trunc(overdue_amt) as int) as varchar) end as overdue_amt,
  case when {_K} = 11 then 'NaN' else '12' end as balance, cast(snapshot_date as varchar) as snapshot_date
from v_loan_daily""")

part("s_loan_text", f"""
select *, case when overdue_amt > 0 then cast(date_diff('day', first_missed_date, snapshot_date) as int) else 0 end as dpd
from (select *, case when installments_missed > 0 then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
from (select loan_id, Customer_ID, cast(loan_start_date as date) as loan_start_date, 10 as tenure, n as installment_num,
             cast(l as float) as loan_amt, cast(d as float) as due_amt, cast(p as float) as paid_amt, cast(o as float) as overdue_amt, cast(b as float) as balance,
             cast(snapshot_date as date) as snapshot_date, n as mob, cast(coalesce(ceil(o / nullif(d, 0)), 0) as int) as installments_missed
      from (select *, cast(coalesce(trunc(try_cast(nullif(trim(installment_num), '') as double)), 0) as int) as n,
                   {', '.join(f"case when {c} in ('', ' ', 'NaN', 'unpaid') then 0 else cast({c} as double) end as {c[0]}" for c in ('loan_amt', 'due_amt', 'paid_amt', 'overdue_amt', 'balance'))}
            from v_loan_text)))""")


@query("loan_daily_text", f"""
select loan_id, Customer_ID, loan_start_date, tenure, installment_num, {rnd('loan_amt', digits=0)}, {rnd('due_amt')}, {rnd('paid_amt', digits=0)}, {rnd('overdue_amt')},
       {rnd('balance')}, snapshot_date, mob, installments_missed, first_missed_date, dpd from s_loan_text""")
def loan_daily_text(spark, sf):
    """Silver loans from text: fractions, blanks, NaN and words among the numbers, all eleven columns."""
    k = F.col("loan_id").cast("long") % 40
    text = {c: F.col(c).cast("string") for c in ("loan_start_date", "loan_amt", "snapshot_date")}
    n, due, over = (F.col(c).cast("int").cast("string") for c in ("installment_num", "due_amt", "overdue_amt"))
    raw_rows = view(spark, sf, "v_loan_daily").withColumns(text | {
        "tenure": F.concat(F.col("tenure").cast("string"), F.lit(".0")),
        "installment_num": F.when(k == 1, F.concat(n, F.lit(".0"))).when(k == 2, F.concat(F.lit("  "), n, F.lit(" "))).when(k == 3, "n/a")
        .when(k == 4, "").when(k == 5, F.concat(n, F.lit(".9"))).otherwise(n),
        "due_amt": F.when(k == 6, "NaN").when(k == 7, "").otherwise(due),
        "paid_amt": F.when(k == 8, "unpaid").otherwise((F.col("due_amt").cast("int") / 2).cast("string")),
        "overdue_amt": F.when(k == 9, " ").when(k == 10, "NaN").otherwise(over),
        "balance": F.when(k == 11, "NaN").otherwise("12"),
    })
    silver = conform.loan_daily(raw_rows)
    whole = {c: F.round(F.col(c).cast("double"), 0) for c in ("loan_amt", "paid_amt")}
    return tidy(silver.withColumns(whole))


@query("days_past_due", """
select snapshot_date, mob, count(*) as n_rows, cast(sum(installments_missed) as bigint) as missed, cast(sum(dpd) as bigint) as dpd,
       count(first_missed_date) as n_late, count(*) - count(dpd) as n_unknown
from s_loan_daily group by 1, 2""")
def days_past_due(spark, sf):
    return conform.loan_daily(view(spark, sf, "v_loan_daily")).groupBy("snapshot_date", "mob").agg(
        F.count("*").alias("n_rows"), F.sum("installments_missed").alias("missed"), F.sum("dpd").alias("dpd"),
        F.count("first_missed_date").alias("n_late"), F.count_if(F.col("dpd").isNull()).alias("n_unknown"),
    )


@query("zero_filled_mob", """
select count(*) as n_rows, count(*) filter (where try_cast(x as int) is null) as n_zero_filled
from (select case when installment_num = 3 then 'n/a' else cast(installment_num as varchar) end as x from v_loan_daily)""")
def zero_filled_mob(spark, sf):
    text = F.when(F.col("installment_num") == 3, "n/a").otherwise(F.col("installment_num").cast("string"))
    return conform.zero_filled_mob(view(spark, sf, "v_loan_daily").withColumn("installment_num", text))


part("s_attributes", f"""
select Customer_ID, nullif(trim(Name), '') as Name,
       case when regexp_matches(trim(SSN), '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') then trim(SSN) end as SSN,
       case when regexp_matches(trim(SSN), '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') then 1 else 0 end as ssn_valid,
       case when {num('Age', 'int')} between 14 and 100 then {num('Age', 'int')} end as Age,
       case when regexp_matches(Occupation, '[A-Za-z]') then Occupation end as Occupation,
       cast(snapshot_date as date) as snapshot_date
from v_attributes""")


@query("silver_attributes", "select * from s_attributes")
def silver_attributes(spark, sf):
    return conform.attributes(view(spark, sf, "v_attributes"))


@query("null_outside", f"""
select Age, count(*) as n_rows, count(case when v between 14 and 100 then v end) as n_kept,
       min(case when v between 14 and 100 then v end) as kept
from (select Age, {num('Age', 'int')} as v from v_attributes) group by 1""")
def null_outside(spark, sf):
    kept = clean.within(clean.numeric("Age", "int"), *C.AGE_RANGE)
    return view(spark, sf, "v_attributes").groupBy("Age").agg(
        F.count("*").alias("n_rows"), F.count(kept).alias("n_kept"), F.min(kept).alias("kept")
    )


@query("dq_shared_ids", """
select (select count(*) from (select SSN from s_attributes where ssn_valid = 1 group by SSN having count(distinct Customer_ID) > 1)) as shared_ids,
       (select count(*) from s_attributes where ssn_valid = 0) as invalid_rows""")
def dq_shared_ids(spark, sf):
    return conform.shared_ids(conform.attributes(view(spark, sf, "v_attributes")))


@query("dq_repeated_keys", """
select count(*) as n_keys, count(*) filter (where n > 1) as n_repeated
from (select Customer_ID, snapshot_date, count(*) as n from v_attributes group by 1, 2)""")
def dq_repeated_keys(spark, sf):
    return conform.repeated_keys(view(spark, sf, "v_attributes"), ["Customer_ID", "snapshot_date"])


def _financials_sql() -> str:
    plain = {c: num(c, t) for c, t in C.FINANCIAL_TYPES.items()}
    for c, (low, high) in C.FINANCIAL_RANGES.items():
        plain[c] = f"case when {plain[c]} between {low} and {high} then {plain[c]} end"
    first = ", ".join(f"{e} as {c}" for c, e in plain.items())
    kept = [c for c in C.FINANCIAL_TYPES if c not in ("Annual_Income", "Total_EMI_per_month", "Amount_invested_monthly")]
    behaviours = ", ".join(f"'{b}'" for b in C.PAYMENT_BEHAVIOURS)
    return f"""
select Customer_ID, {', '.join(kept)},
       case when Annual_Income <= cast(36 * cast(Monthly_Inhand_Salary as double) as float) then Annual_Income end as Annual_Income,
       case when Total_EMI_per_month <= Monthly_Inhand_Salary then Total_EMI_per_month end as Total_EMI_per_month,
       case when Amount_invested_monthly <> 10000 then Amount_invested_monthly end as Amount_invested_monthly,
       try_cast(regexp_extract(age, '(\\d+)\\s*Years', 1) as int) * 12
         + coalesce(try_cast(regexp_extract(age, '(\\d+)\\s*Months', 1) as int), 0) as Credit_History_Age_months,
       case when Credit_Mix in ('Good', 'Standard', 'Bad') then Credit_Mix end as Credit_Mix,
       case when Payment_of_Min_Amount in ('Yes', 'No', 'NM') then Payment_of_Min_Amount end as Payment_of_Min_Amount,
       case when Payment_Behaviour in ({behaviours}) then Payment_Behaviour end as Payment_Behaviour,
       regexp_replace(regexp_replace(Type_of_Loan, '\\s*,\\s*(and\\s+)?', ',', 'g'), '^and\\s+', '') as Type_of_Loan,
       cast(snapshot_date as date) as snapshot_date
from (select Customer_ID, {first}, Credit_History_Age as age, Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour, Type_of_Loan,
             snapshot_date from v_financials)"""


part("s_financials", _financials_sql())
_FIN_FLOATS = [c for c, t in C.FINANCIAL_TYPES.items() if t == "float"]
_FIN_OTHERS = ["Customer_ID", *[c for c, t in C.FINANCIAL_TYPES.items() if t == "int"], "Credit_History_Age_months",
               "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Type_of_Loan", "snapshot_date"]


@query("silver_financials", f"select {', '.join(_FIN_OTHERS)}, {', '.join(rnd(c) for c in _FIN_FLOATS)} from s_financials")
def silver_financials(spark, sf):
    return tidy(conform.financials(view(spark, sf, "v_financials")))


@query("clean_numeric", "select Customer_ID, snapshot_date, " + ", ".join(
    rnd(num(c, t), c) if t == "float" else f"{num(c, t)} as {c}" for c, t in C.FINANCIAL_TYPES.items()) + " from v_financials")
def clean_numeric(spark, sf):
    return tidy(view(spark, sf, "v_financials").select(
        "Customer_ID", "snapshot_date", *[clean.numeric(c, t).alias(c) for c, t in C.FINANCIAL_TYPES.items()]
    ))


@query("cross_column_rules", f"""
select Customer_ID, snapshot_date, {rnd('case when income <= cast(36 * cast(salary as double) as float) then income end', 'income')},
       {rnd('case when emi <= salary then emi end', 'emi')}
from (select Customer_ID, snapshot_date, {num('Annual_Income', 'float')} as income, {num('Monthly_Inhand_Salary', 'float')} as salary,
             {num('Total_EMI_per_month', 'float')} as emi from v_financials)""")
def cross_column_rules(spark, sf):
    income, salary, emi = (clean.numeric(c) for c in ("Annual_Income", "Monthly_Inhand_Salary", "Total_EMI_per_month"))
    return tidy(view(spark, sf, "v_financials").select(
        "Customer_ID", "snapshot_date",
        clean.at_most(income, (C.INCOME_CAP_IN_SALARIES * salary).cast("float")).alias("income"),
        clean.at_most(emi, salary).alias("emi"),
    ))


@query("sentinel_null", f"""
select Customer_ID, snapshot_date, {rnd('case when v <> 10000 then v end', 'invested')}
from (select Customer_ID, snapshot_date, {num('Amount_invested_monthly', 'float')} as v from v_financials)""")
def sentinel_null(spark, sf):
    invested = clean.not_sentinel(clean.numeric("Amount_invested_monthly"), C.INVESTED_SENTINEL)
    return tidy(view(spark, sf, "v_financials").select("Customer_ID", "snapshot_date", invested.alias("invested")))


@query("credit_history_months", """
select Credit_History_Age, try_cast(regexp_extract(Credit_History_Age, '(\\d+) Years', 1) as int) * 12
         + coalesce(try_cast(regexp_extract(Credit_History_Age, '(\\d+) Months', 1) as int), 0) as history, count(*) as n_rows
from v_financials group by 1, 2""")
def credit_history_months(spark, sf):
    return view(spark, sf, "v_financials").groupBy(
        "Credit_History_Age", clean.span_in_months("Credit_History_Age").alias("history")
    ).agg(F.count("*").alias("n_rows"))


@query("category_whitelist", """
select Credit_Mix as mix, Payment_of_Min_Amount as pays_minimum, Payment_Behaviour as behaviour, count(*) as n_rows
from s_financials group by 1, 2, 3""")
def category_whitelist(spark, sf):
    return view(spark, sf, "v_financials").groupBy(
        clean.one_of("Credit_Mix", C.CREDIT_MIXES).alias("mix"),
        clean.one_of("Payment_of_Min_Amount", C.MIN_AMOUNT_ANSWERS).alias("pays_minimum"),
        clean.one_of("Payment_Behaviour", C.PAYMENT_BEHAVIOURS).alias("behaviour"),
    ).agg(F.count("*").alias("n_rows"))


@query("loan_type_normalise", """
select Type_of_Loan as raw_text, replace(replace(Type_of_Loan, ', and ', ','), ', ', ',') as listed, count(*) as n_rows
from v_financials group by 1, 2""")
def loan_type_normalise(spark, sf):
    return view(spark, sf, "v_financials").groupBy(
        F.col("Type_of_Loan").alias("raw_text"), clean.comma_list("Type_of_Loan").alias("listed")
    ).agg(F.count("*").alias("n_rows"))


_FE = C.CLICK_COLUMNS
part("s_click_months", f"""
select Customer_ID, cast(snapshot_date as date) as snapshot_date, {', '.join(f"{num(c, 'int')} as {c}" for c in _FE)}
from v_click_months""")


@query("silver_clickstream", "select * from s_click_months")
def silver_clickstream(spark, sf):
    return conform.clickstream(view(spark, sf, "v_click_months"))


@query("dedup_customer_month", """
select Customer_ID, snapshot_date, fe_1, fe_2, fe_3, fe_4, fe_5 from (
  select *, row_number() over (partition by Customer_ID, snapshot_date order by fe_1 nulls first, fe_2, fe_3, fe_4, fe_5) as rn
  from (select * from v_clickstream union all select * from v_clickstream
        union all select * replace (case when fe_1 % 2 = 0 then null else fe_1 + 1 end as fe_1) from v_clickstream)) where rn = 1""")
def dedup_customer_month(spark, sf):
    clicks = view(spark, sf, "v_clickstream")
    changed = clicks.withColumn("fe_1", F.when(F.col("fe_1") % 2 != 0, F.col("fe_1") + 1))
    copies = clicks.unionByName(clicks).unionByName(changed)
    return conform.one_per(copies, ["Customer_ID", "snapshot_date"], [f"fe_{i}" for i in range(1, 6)])


@query("scalar_tour", """
select lower(replace(replace(Occupation, '-', '_'), ' ', '_')) as job, trim(Name) as name, starts_with(SSN, '0') as starts_zero,
       Occupation in ('Teacher', 'Manager') as listed, string_split(SSN, '-')[1] as first_part, regexp_extract(SSN, '(\\d+)-', 1) as digits,
       list_contains(string_split(SSN, '-'), '0001') as has_tail,
       cast(cast(snapshot_date as date) + interval 3 month as date) as later,
       cast(date_diff('day', date '1995-01-01', cast(snapshot_date as date)) as int) as days,
       cast(ceil(length(Name) / 4.0) as bigint) as quarter, abs(try_cast(Age as int)) as age, round(ln(greatest(length(Name), 1)), 6) as ln_name,
       cast(least(length(Name), 9) as int) as short, coalesce(try_cast(Age as int), 0) as filled
from v_attributes""")
def scalar_tour(spark, sf):
    """The scalar functions in use, on whole rows."""
    snapshot = F.col("snapshot_date").cast("date")
    length = F.length("Name")
    age = F.col("Age").try_cast("int")
    return view(spark, sf, "v_attributes").select(
        F.lower(F.translate("Occupation", "- ", "__")).alias("job"), F.trim("Name").alias("name"),
        F.col("SSN").startswith("0").alias("starts_zero"), F.col("Occupation").isin("Teacher", "Manager").alias("listed"),
        F.split("SSN", "-")[0].alias("first_part"), F.regexp_extract("SSN", r"(\d+)-", 1).alias("digits"),
        F.array_contains(F.split("SSN", "-"), "0001").alias("has_tail"),
        F.add_months(snapshot, 3).alias("later"), F.datediff(snapshot, F.lit("1995-01-01").cast("date")).alias("days"),
        F.ceil(length / 4).alias("quarter"), F.abs(age).alias("age"),
        F.round(F.ln(F.greatest(length, F.lit(1))), 6).alias("ln_name"),
        F.least(length, F.lit(9)).alias("short"), F.coalesce(age, F.lit(0)).alias("filled"),
    )
