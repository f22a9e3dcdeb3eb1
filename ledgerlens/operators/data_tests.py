"""Tests on published reports: completeness, uniqueness, and no way back to a person."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlens.contracts import ContractViolation

# Keys that resolve to one party or account.
IDENTIFIERS = ["customer_id", "exposure_id", "name_orig", "name_dest"]

# What is tested on each reporting model.
REPORT_TESTS = {
    "rwa_monthly_trend": {
        "reporting_date": ["not_null", "unique"], "total_capital": ["not_null"],
    },
    "capital_by_grade": {"rating_grade": ["not_null"]},
    "alerts_by_rule": {"rule": ["not_null", "unique"], "precision": ["not_null"]},
    "alerts_by_type": {"type": ["not_null", "unique"]},
}


def run_tests(report: DataFrame, tests: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per test: `column_name, test, failures`. All tests share one aggregate.

    Failures are null values, or rows beyond the first of a non-null value.
    """
    measures = {
        "not_null": lambda c: F.count_if(F.col(c).isNull()),
        "unique": lambda c: F.count(F.col(c)) - F.count_distinct(F.col(c)),
    }
    wanted = [(c, t) for c, names in tests.items() for t in names]
    counted = report.agg(
        *[measures[test](column).alias(f"t_{i}") for i, (column, test) in enumerate(wanted)]
    )
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(column).alias("column_name"), F.lit(test).alias("test"),
            F.col(f"t_{i}").alias("failures"),
        )
        for i, (column, test) in enumerate(wanted)
    ])))


def forbid_identifiers(report: DataFrame, identifiers: Sequence[str] = IDENTIFIERS) -> None:
    """Raise where an aggregate report carries a column that names a party."""
    leaked = sorted(set(report.columns) & set(identifiers))
    if leaked:
        raise ContractViolation(f"a report must not expose {leaked}")
