"""Silver exposures: platform names and types, and the rules a record must satisfy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.contracts import Contract, split_by_rules
from ledgerlens.functions.finance import MONEY, RATE

CONTRACT = "credit_risk_exposure_silver"

# Silver column, source column and, where it changes, the silver type.
LAYOUT = [
    ("exposure_id", "exposure_id", None),
    ("customer_id", "customer_id", None),
    ("origination_date", "issue_d", "date"),
    ("term_months", "term_months", "smallint"),
    ("maturity_date", None, "date"),
    ("original_amount", "loan_amnt", MONEY),
    ("outstanding_amount", "outstanding_amount", MONEY),
    ("provision_amount", "provision_amount", MONEY),
    ("interest_rate", "int_rate", RATE),
    ("rating_grade", "grade", None),
    ("rating_subgrade", "sub_grade", None),
    ("status", "status", None),
    ("days_past_due", "days_past_due", "int"),
    ("default_flag", "default_flag", "boolean"),
    ("purpose", "purpose", None),
    ("region", "addr_state", None),
    ("annual_income", "annual_inc", MONEY),
    ("debt_to_income", "dti", "decimal(8,4)"),
    ("fico_low", "fico_range_low", "smallint"),
    ("fico_high", "fico_range_high", "smallint"),
    ("home_ownership", "home_ownership", None),
    ("emp_length", "emp_length", None),
    ("verification_status", "verification_status", None),
    ("application_type", "application_type", None),
]


def conform(df: DataFrame, *carry: str) -> DataFrame:
    """Source columns to the silver layout; `carry` keeps further columns as they are.

    A value its type cannot hold becomes null instead of failing the job, so that one bad
    record is quarantined rather than stopping the book.
    """
    def column(name: str, source: str | None, kind: str | None) -> Column:
        if name == "maturity_date":
            value = F.add_months(
                F.col("issue_d").cast("date"), F.col("term_months").cast("int")
            )
        else:
            value = F.col(source)
        return (value.try_cast(kind) if kind else value).alias(name)

    return df.select(*[column(*entry) for entry in LAYOUT], *carry)


def rules() -> list[tuple[str, Column]]:
    """The rules of the silver contract. Silver rows keep columns that it does not declare."""
    return Contract.named(CONTRACT).rules()


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records fit for silver, records that are not with the rules they broke)."""
    return split_by_rules(df, rules())
