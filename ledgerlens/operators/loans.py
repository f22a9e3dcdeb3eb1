"""The loan master: raw extract rows to typed, keyed loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType, StringType, StructField, StructType,
)

from ledgerlens.functions.dates import month_year
from ledgerlens.functions.keys import exposure_key, is_natural_key, pseudonym

# The columns taken from the extract. Static ones are set at origination,
# outcome ones describe the final observed state. Free text and addresses are not taken.
STATIC = [
    "id", "issue_d", "term", "loan_amnt", "funded_amnt", "int_rate", "installment",
    "grade", "sub_grade", "purpose", "addr_state", "annual_inc", "dti",
    "application_type", "home_ownership", "emp_length", "verification_status",
    "fico_range_low", "fico_range_high",
]
OUTCOME = [
    "loan_status", "out_prncp", "total_pymnt", "total_rec_prncp", "last_pymnt_d", "recoveries",
]
# Which of those are numbers. Everything else, the id included, is text.
NUMERIC = {
    "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti",
    "fico_range_low", "fico_range_high", "out_prncp", "total_pymnt", "total_rec_prncp",
    "recoveries",
}


def raw_schema(columns: list[str] | None = None) -> StructType:
    """A declared schema for the extract: inference would give the id a type per chunk."""
    return StructType([
        StructField(name, DoubleType() if name in NUMERIC else StringType())
        for name in (columns or STATIC + OUTCOME)
    ])


def _with_keys_and_dates(raw: DataFrame) -> DataFrame:
    if absent := sorted(set(STATIC + OUTCOME) - set(raw.columns)):
        raise ValueError(f"the extract lacks the columns {', '.join(absent)}")
    digits = F.regexp_extract("term", r"(\d+)", 1)
    return (
        raw.select(*STATIC, *OUTCOME)
        .withColumns({
            "issue_d": month_year(F.col("issue_d")),
            "last_pymnt_d": month_year(F.col("last_pymnt_d")),
            "term_months": F.when(digits != "", digits).try_cast("smallint"),
            "customer_id": pseudonym(F.col("id")),
            "exposure_id": exposure_key(F.col("id")),
        })
        .drop("term")
    )


def loan_master(raw: DataFrame) -> DataFrame:
    """Loans with a clean natural key and a readable issue date, 27 columns."""
    return _with_keys_and_dates(raw.filter(is_natural_key(F.col("id")))).filter(
        F.col("issue_d").isNotNull()
    )


def reject_counts() -> list[Column]:
    """Aggregates of an extract: rows read, left out by `loan_master` and why, and kept."""
    keyed = is_natural_key(F.col("id"))
    dated = month_year(F.col("issue_d")).isNotNull()
    return [
        F.count("*").alias("rows_read"),
        F.count_if(~keyed).alias("rejected_key"),
        F.count_if(keyed & ~dated).alias("rejected_issue_date"),
        F.count_if(keyed & dated).alias("rows_kept"),
    ]


def loan_rejects(raw: DataFrame) -> DataFrame:
    """What `loan_master` leaves out, counted in one pass over two columns."""
    return raw.agg(*reject_counts())
