"""Raw to silver: typed and cleaned tables, one ``select`` per table, all months together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.functions import cleaning as clean


def enforce_types(df: DataFrame, types: dict) -> DataFrame:
    """Listed columns cast in one projection, others passed on."""
    return df.select(*[clean.typed(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def loan_daily(raw: DataFrame) -> DataFrame:
    """Typed repayments with months on book and days past due.

    Every number that is null or NaN becomes 0, months on book included; ``zero_filled_mob`` counts those rows.
    """
    typed = enforce_types(raw, C.LOAN_DAILY_TYPES)

    def filled_number(c):
        kind = C.LOAN_DAILY_TYPES.get(c)
        if kind not in ("int", "float"):
            return F.col(c)
        zero = F.lit(0).cast(kind)
        return F.coalesce(F.nanvl(c, zero) if kind == "float" else F.col(c), zero).alias(c)

    filled = typed.select(
        *[filled_number(c) for c in typed.columns],
        F.coalesce(F.col("installment_num"), F.lit(0)).alias("mob"),
        clean.missed_instalments("overdue_amt", "due_amt").alias("installments_missed"),
    )
    dated = filled.withColumn("first_missed_date", clean.first_missed("snapshot_date", "installments_missed"))
    return dated.withColumn("dpd", clean.days_past_due("overdue_amt", "snapshot_date", "first_missed_date"))


def zero_filled_mob(raw: DataFrame) -> DataFrame:
    """Rows whose unreadable instalment number turns them into an application row."""
    return raw.agg(
        F.count("*").alias("n_rows"),
        F.count_if(clean.typed("installment_num", "int").isNull()).alias("n_zero_filled"),
    )


def numbers(raw: DataFrame, types: dict) -> DataFrame:
    """Listed text columns as cleaned numbers. A projection of its own, so that the rules on top of it, which name a
    number several times, do not parse its text several times."""
    return raw.select(*[clean.numeric(c, types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def attributes(raw: DataFrame) -> DataFrame:
    valid = clean.matches("SSN", C.ID_PATTERN)
    checked = numbers(raw, {"Age": "int"}).withColumn("ssn_valid", valid.cast("int"))
    return checked.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        clean.filled("Name").alias("Name"),
        F.when(F.col("ssn_valid") == 1, F.trim("SSN")).alias("SSN"),
        "ssn_valid",
        clean.within("Age", *C.AGE_RANGE).alias("Age"),
        clean.with_letter("Occupation").alias("Occupation"),
        clean.typed("snapshot_date", "date").alias("snapshot_date"),
    )


def financials(raw: DataFrame) -> DataFrame:
    """Fifteen cleaned numbers, history in months, whitelisted categories; unlisted columns pass through."""
    # the cap is rounded to float, the type of the income it is compared with
    cap = (F.lit(C.INCOME_CAP_IN_SALARIES) * F.col("Monthly_Inhand_Salary")).cast("float")
    cleaned = {
        **{c: clean.within(c, low, high) for c, (low, high) in C.FINANCIAL_RANGES.items()},
        "Annual_Income": clean.at_most("Annual_Income", cap),
        "Total_EMI_per_month": clean.at_most("Total_EMI_per_month", F.col("Monthly_Inhand_Salary")),
        "Amount_invested_monthly": clean.not_sentinel("Amount_invested_monthly", C.INVESTED_SENTINEL),
        "Customer_ID": F.col("Customer_ID").cast("string"),
        "Credit_Mix": clean.one_of("Credit_Mix", C.CREDIT_MIXES),
        "Payment_of_Min_Amount": clean.one_of("Payment_of_Min_Amount", C.MIN_AMOUNT_ANSWERS),
        "Payment_Behaviour": clean.one_of("Payment_Behaviour", C.PAYMENT_BEHAVIOURS),
        "Type_of_Loan": clean.comma_list("Type_of_Loan"),
        "snapshot_date": clean.typed("snapshot_date", "date"),
    }
    kept = [c for c in raw.columns if c != "Credit_History_Age"]
    return numbers(raw, C.FINANCIAL_TYPES).select(
        *[cleaned.get(c, F.col(c)).alias(c) for c in kept],
        clean.span_in_months("Credit_History_Age").alias("Credit_History_Age_months"),
    )


def one_per(df: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """One row per key: the smallest payload (nulls first, column by column).

    An aggregate, so copies collapse before the shuffle and a much-repeated key costs one row per task.
    """
    smallest = F.min(F.struct(*payload)).alias("_row")
    return df.groupBy(*keys).agg(smallest).select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


def clickstream(raw: DataFrame, columns=C.CLICK_COLUMNS) -> DataFrame:
    columns = list(columns)
    typed = raw.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        clean.typed("snapshot_date", "date").alias("snapshot_date"),
        *[clean.numeric(c, "int").alias(c) for c in columns],
    )
    return one_per(typed, ["Customer_ID", "snapshot_date"], columns)


def shared_ids(attrs: DataFrame) -> DataFrame:
    """One row: how many valid ids belong to several customers, and how many ids are invalid.

    Reduced to (id, customer) pairs before counting, so no id is gathered in one place.
    """
    pairs = attrs.groupBy("SSN", "Customer_ID").agg(F.count_if(F.col("ssn_valid") == 0).alias("bad"))
    ids = pairs.groupBy("SSN").agg(F.count("Customer_ID").alias("owners"), F.sum("bad").alias("bad"))
    return ids.agg(
        F.count_if(F.col("SSN").isNotNull() & (F.col("owners") > 1)).alias("shared_ids"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_rows"),
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Data-quality count of keys that would fan out a join."""
    counts = df.groupBy(*keys).count()
    return counts.agg(F.count("*").alias("n_keys"), F.count_if(F.col("count") > 1).alias("n_repeated"))
