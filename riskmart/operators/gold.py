"""Label store and point-in-time feature store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.functions import encoding as enc
from riskmart.operators.joins import spread_join


def labels(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Default label of every loan at a month on book; unknown days past due count as good."""
    return loans.where(F.col("mob") == mob).select(
        "loan_id", "Customer_ID",
        enc.flag(F.col("dpd") >= dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def applications(loans: DataFrame) -> DataFrame:
    """Loans at month 0. ``run_month`` is the month whose customer data applies; the start date is kept as
    the snapshot date of the feature row."""
    return loans.where(F.col("mob") == 0).select(
        "loan_id", "Customer_ID", F.col("loan_start_date").alias("snapshot_date"),
        F.col("loan_amt").cast("float").alias("loan_amt"), F.col("tenure").cast("int").alias("tenure"),
        F.col("snapshot_date").alias("run_month"),
    )


def click_history(clicks: DataFrame, moments: DataFrame, columns=C.CLICK_COLUMNS, at: str = "run_month") -> DataFrame:
    """Per (customer, moment): mean of each column and number of periods, over all periods <= moment.

    History and moments are stacked and read with one running window, history first on equal dates. After
    deduplication a customer has at most one history row and one moment per calendar period, so the
    window is bounded by the calendar however busy the customer is.
    """
    columns = list(columns)
    history = clicks.select("Customer_ID", F.col("snapshot_date").alias(at), F.lit(0).alias("_moment"), *columns)
    asked = moments.select("Customer_ID", at).distinct().withColumn("_moment", F.lit(1))
    stacked = history.unionByName(asked, allowMissingColumns=True)
    past = (
        W.partitionBy("Customer_ID").orderBy(at, "_moment").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return stacked.select(
        "Customer_ID", at, "_moment",
        *[F.avg(c).over(past).cast("float").alias(f"{c}_avg") for c in columns],
        F.count_if(F.col("_moment") == 0).over(past).cast("int").alias("clickstream_months_observed"),
    ).where("_moment = 1").drop("_moment")


def history_columns(columns=C.CLICK_COLUMNS) -> list[Column]:
    """Click features with a stable shape: no history is 0 periods and null means."""
    observed = F.coalesce(F.col("clickstream_months_observed"), F.lit(0))
    return [
        (observed > 0).cast("int").alias("has_clickstream"),
        observed.alias("clickstream_months_observed"),
        *[F.col(f"{c}_avg") for c in columns],
    ]


def application_base(apps: DataFrame, attrs: DataFrame, fins: DataFrame, *more: DataFrame) -> DataFrame:
    """Customer data of the run month joined to the applications; personal data stays behind."""
    month = F.col("snapshot_date").alias("run_month")
    attrs = attrs.select(month, *[c for c in attrs.columns if c not in ("Name", "SSN", "ssn_valid", "snapshot_date")])
    fins = fins.select(month, *[c for c in fins.columns if c != "snapshot_date"])
    return spread_join(apps, [attrs, fins, *more], ["Customer_ID", "run_month"], "left")


def occupation_columns() -> list[Column]:
    return enc.one_hot("Occupation", C.OCCUPATIONS, "occupation", unknown=True)


def loan_type_columns() -> list[Column]:
    return enc.multi_hot("Type_of_Loan", C.LOAN_TYPES, "has", count_as="num_loan_types")


def behaviour_columns() -> list[Column]:
    size = F.regexp_extract("Payment_Behaviour", r"spent_(\w+?)_value", 1)
    return [
        enc.ordinal(F.col("Credit_Mix"), C.CREDIT_MIX_RANK).alias("credit_mix_ordinal"),
        *enc.one_hot("Payment_of_Min_Amount", C.MIN_AMOUNT_ANSWERS, "min_payment"),
        enc.starts("Payment_Behaviour", "High", "Low").alias("spend_level_high"),
        enc.ordinal(size, C.PAYMENT_SIZE_RANK).alias("payment_value_ordinal"),
    ]


def ratio_columns() -> list[Column]:
    delayed = F.when(F.col("Num_of_Loan") > 0, F.try_divide(F.col("Num_of_Delayed_Payment"), F.col("Num_of_Loan")))
    return [
        enc.ratio("Outstanding_Debt", "Annual_Income").alias("debt_to_annual_income"),
        enc.ratio("Total_EMI_per_month", "Monthly_Inhand_Salary").alias("emi_to_monthly_salary"),
        enc.ratio("Amount_invested_monthly", "Monthly_Inhand_Salary").alias("invested_to_monthly_salary"),
        enc.ratio("Monthly_Balance", "Monthly_Inhand_Salary").alias("balance_to_monthly_salary"),
        delayed.cast("float").alias("delayed_payments_per_loan"),
    ]


def features(loans: DataFrame, attrs: DataFrame, fins: DataFrame, clicks: DataFrame, columns=C.CLICK_COLUMNS, run_month: bool = False) -> DataFrame:
    """Feature store over all application months: 3 keys and 78 features in fixed order, on request also the run month.

    The run month is the month of the loan row; a row's snapshot date is the loan's start, which may lie in another month.
    """
    apps = applications(loans)
    past = click_history(clicks, apps, columns)
    base = application_base(apps, attrs, fins, past)
    return base.select(
        *C.KEYS, "loan_amt", "tenure", *C.NUMERIC_FEATURES, *ratio_columns(),
        *occupation_columns(), *loan_type_columns(), *behaviour_columns(), *history_columns(columns), *(["run_month"] if run_month else []),
    )
