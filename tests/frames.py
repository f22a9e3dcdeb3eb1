"""Small frames with one valid row that a test changes field by field."""

from datetime import date
from decimal import Decimal as D

ENGINE_INPUT = (
    "reporting_date date, exposure_id string, customer_id string, exposure_class string, "
    "original_amount decimal(18,2), outstanding_amount decimal(18,2), "
    "undrawn_amount decimal(18,2), currency string, rating_grade string, "
    "rating_subgrade string, origination_date date, maturity_date date, term_months int, "
    "interest_rate decimal(6,4), status string, days_past_due int, default_flag boolean, "
    "default_date date, provision_amount decimal(18,2), collateral_flag boolean, "
    "collateral_value decimal(18,2), purpose string, region string"
)
ENGINE_INPUT_ROW = dict(
    reporting_date=date(2018, 12, 31), exposure_id="LC-1", customer_id="c1",
    exposure_class="retail_other", original_amount=D("8400.00"),
    outstanding_amount=D("3150.00"), undrawn_amount=D("0.00"), currency="USD",
    rating_grade="B", rating_subgrade="B1", origination_date=date(2016, 5, 1),
    maturity_date=date(2019, 5, 1), term_months=36, interest_rate=D("9.7500"),
    status="performing", days_past_due=0, default_flag=False, default_date=None,
    provision_amount=D("0.00"), collateral_flag=False, collateral_value=D("0.00"),
    purpose="boat", region="OR",
)

SOURCE = (
    "exposure_id string, customer_id string, issue_d date, term_months smallint, "
    "loan_amnt double, outstanding_amount double, provision_amount double, int_rate double, "
    "grade string, sub_grade string, status string, days_past_due int, default_flag boolean, "
    "purpose string, addr_state string, annual_inc double, dti double, fico_range_low double, "
    "fico_range_high double, home_ownership string, emp_length string, "
    "verification_status string, application_type string"
)
SOURCE_ROW = dict(
    exposure_id="LC-1", customer_id="c1", issue_d=date(2016, 5, 1), term_months=36,
    loan_amnt=8400.0, outstanding_amount=3150.0, provision_amount=0.0, int_rate=9.75,
    grade="B", sub_grade="B1", status="performing", days_past_due=0, default_flag=False,
    purpose="boat", addr_state="OR", annual_inc=48300.0, dti=22.1, fico_range_low=655.0,
    fico_range_high=659.0, home_ownership="OWN", emp_length="3 years",
    verification_status="Not Verified", application_type="Individual",
)

MASTER = (
    "exposure_id string, customer_id string, issue_d date, last_pymnt_d date, loan_status string, "
    "loan_amnt double, int_rate double, term_months smallint, recoveries double, grade string, "
    "sub_grade string, purpose string, addr_state string, annual_inc double, dti double, "
    "fico_range_low double, fico_range_high double, home_ownership string, emp_length string, "
    "verification_status string, application_type string"
)
MASTER_ROW = dict(
    exposure_id="LC-1", customer_id="c1", issue_d=date(2016, 1, 1), last_pymnt_d=None,
    loan_status="Current", loan_amnt=10000.0, int_rate=12.0, term_months=36, recoveries=None,
    grade="B", sub_grade="B1", purpose="boat", addr_state="OR", annual_inc=48300.0, dti=22.1,
    fico_range_low=655.0, fico_range_high=659.0, home_ownership="OWN", emp_length="3 years",
    verification_status="Not Verified", application_type="Individual",
)

TXN = (
    "step int, type string, amount decimal(18,2), name_orig string, name_dest string, "
    "old_balance_orig decimal(18,2), new_balance_orig decimal(18,2), is_fraud int"
)
TXN_ROW = dict(
    step=1, type="TRANSFER", amount=D("100.00"), name_orig="A1", name_dest="B1",
    old_balance_orig=D("500.00"), new_balance_orig=D("400.00"), is_fraud=0,
)


def frame(spark, ddl, base, *changes):
    return spark.createDataFrame([{**base, **c} for c in (changes or [{}])], ddl)


def engine_input(spark, *changes):
    return frame(spark, ENGINE_INPUT, ENGINE_INPUT_ROW, *changes)


def source(spark, *changes):
    return frame(spark, SOURCE, SOURCE_ROW, *changes)


def master(spark, *changes):
    return frame(spark, MASTER, MASTER_ROW, *changes)


def txns(spark, *changes):
    decimals = ("amount", "old_balance_orig", "new_balance_orig")
    fixed = [
        {k: D(str(v)) if k in decimals else v for k, v in c.items()} for c in (changes or [{}])
    ]
    return frame(spark, TXN, TXN_ROW, *fixed)
