"""Business rules: windows, thresholds and vocabularies."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- Fixed values: column lists, vocabularies and ranges of the data products. ---

KEYS = ["loan_id", "Customer_ID", "snapshot_date"]

LOAN_DAILY_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "float", "due_amt": "float", "paid_amt": "float",
    "overdue_amt": "float", "balance": "float", "snapshot_date": "date",
}

FINANCIAL_TYPES = {
    "Annual_Income": "float", "Monthly_Inhand_Salary": "float", "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int", "Interest_Rate": "int", "Num_of_Loan": "int", "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int", "Changed_Credit_Limit": "float", "Num_Credit_Inquiries": "int",
    "Outstanding_Debt": "float", "Credit_Utilization_Ratio": "float", "Total_EMI_per_month": "float",
    "Amount_invested_monthly": "float", "Monthly_Balance": "float",
}

FINANCIAL_RANGES = {
    "Num_Bank_Accounts": (0, 20), "Num_Credit_Card": (0, 20), "Interest_Rate": (0, 50), "Num_of_Loan": (0, 20),
    "Num_of_Delayed_Payment": (0, 50), "Num_Credit_Inquiries": (0, 50), "Monthly_Balance": (-1e6, 1e6),
}

AGE_RANGE = (14, 100)
INCOME_CAP_IN_SALARIES = 36
INVESTED_SENTINEL = 10000
ID_PATTERN = r"^\d{3}-\d{2}-\d{4}$"

CREDIT_MIXES = ["Good", "Standard", "Bad"]
MIN_AMOUNT_ANSWERS = ["Yes", "No", "NM"]
PAYMENT_BEHAVIOURS = [
    "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments", "Low_spent_Large_value_payments",
    "High_spent_Small_value_payments", "High_spent_Medium_value_payments", "High_spent_Large_value_payments",
]
OCCUPATIONS = [
    "Accountant", "Architect", "Developer", "Doctor", "Engineer", "Entrepreneur", "Journalist", "Lawyer",
    "Manager", "Mechanic", "Media_Manager", "Musician", "Scientist", "Teacher", "Writer",
]
LOAN_TYPES = [
    "Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan", "Home Equity Loan", "Mortgage Loan",
    "Payday Loan", "Personal Loan", "Student Loan", "Not Specified",
]
CREDIT_MIX_RANK = {"Bad": 0, "Standard": 1, "Good": 2}
PAYMENT_SIZE_RANK = {"Small": 0, "Medium": 1, "Large": 2}

CLICK_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

NUMERIC_FEATURES = [
    "Age", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
    "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age_months",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]

REQUIRED_COLUMNS = {
    "loan_daily": ["loan_id", "Customer_ID", "loan_start_date", "installment_num", "due_amt", "overdue_amt",
                   "snapshot_date"],
    "attributes": ["Customer_ID", "Age", "Occupation", "snapshot_date"],
    "financials": ["Customer_ID", "Annual_Income", "Outstanding_Debt", "Credit_Mix", "snapshot_date"],
    "clickstream": ["Customer_ID", "fe_1", "fe_20", "snapshot_date"],
}

PSI_FLOOR = 1e-4
TRIGGER_METRICS = ["auc", "calibration_gap", "psi_score"]

# --- End of fixed values. ---


@dataclass(frozen=True)
class Policy:
    """Dates, cadences and alert thresholds of one deployment."""

    pipeline_start: date = date(2023, 1, 1)
    pipeline_end: date = date(2025, 7, 1)
    feature_start: date = date(2023, 1, 1)
    feature_end: date = date(2025, 1, 1)
    go_live: date = date(2024, 1, 1)
    label_dpd: int = 30
    label_mob: int = 6
    retrain_every_months: int = 2
    oot_months: int = 2
    test_month_share: float = 0.2
    cv_folds: int = 3
    seed: int = 88
    search_draws: int = 20
    # labelled rows up to which fits of boosted trees get them through the driver; beyond, their tasks read them. Every fit takes all rows
    fit_rows: int = 100_000
    tie_tolerance: float = 0.005
    promotion_tolerance: float = 0.0
    top_features_monitored: int = 10
    top_features_on_card: int = 15
    psi_lights: tuple = (0.10, 0.25)
    auc_drop_lights: tuple = (0.03, 0.05)
    calibration_lights: tuple = (0.05, 0.10)
    missing_increase_red: float = 0.20
    feature_sets: dict = field(default_factory=lambda: {"model_1": "full", "model_2": "core"})

    def table_windows(self) -> dict:
        """First and last month in which each table has data."""
        pipeline = (self.pipeline_start, self.pipeline_end)
        features = (self.feature_start, self.feature_end)
        return {
            "loan_daily": pipeline, "attributes": features, "financials": features,
            "clickstream": features, "label_store": pipeline, "feature_store": features,
        }


PRODUCTION = "production"


def slug(text: str) -> str:
    """Column-name form of a category."""
    return text.lower().translate(str.maketrans("- ", "__"))


def clickstream_features(columns=CLICK_COLUMNS) -> list:
    return ["has_clickstream", "clickstream_months_observed"] + [f"{c}_avg" for c in columns]
