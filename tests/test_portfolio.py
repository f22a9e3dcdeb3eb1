"""Loan master and lifecycle, against a loan-by-loan statement of the rules."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from frames import MASTER, MASTER_ROW, master
from ledgerlens.functions.dates import DAILY, MONTH_END, date_spine, month_year
from ledgerlens.functions.finance import amortised_balance, calendar_months
from ledgerlens.operators.loans import loan_master, loan_rejects, raw_schema
from ledgerlens.operators.portfolio import portfolio_as_of, portfolio_metrics, positions

DEFAULTED = {"Charged Off", "Default", "Does not meet the credit policy. Status:Charged Off"}
SETTLED = {"Fully Paid", "Does not meet the credit policy. Status:Fully Paid"}


def expected(loan, snap):
    """(status, dpd, balance, provision), or None when the loan is not on the book."""
    issue, paid = loan["issue_d"], loan["last_pymnt_d"]
    if issue > snap:
        return None

    def months(a):
        return (snap.year - a.year) * 12 + snap.month - a.month

    m = months(issue)
    months_paid = max(m - months(paid or issue), 0)
    stopped = m > months_paid
    defaulted, settled = loan["loan_status"] in DEFAULTED, loan["loan_status"] in SETTLED
    days = (snap - paid).days if paid else 0
    dpd = max(days, 0) if defaulted and stopped else 0
    status = "performing"
    if dpd > 0:
        status = "past_due"
    if dpd >= 90:
        status = "defaulted"
    if dpd >= 180:
        status = "written_off"
    if settled and stopped:
        status = "closed"
    age = dpd - 180 if status == "written_off" else days if status == "closed" else 0
    if age > 30:
        return None
    if status in ("written_off", "closed"):
        balance = 0.0
    elif loan["int_rate"] is None:
        balance = 0.0
    else:
        n = loan["term_months"]
        k = min(max(min(m, months_paid if defaulted or settled else m), 0), n)
        r = loan["int_rate"] / 100 / 12
        if r == 0:
            balance = loan["loan_amnt"] * (1 - k / n)
        else:
            balance = loan["loan_amnt"] * ((1 + r) ** n - (1 + r) ** k) / ((1 + r) ** n - 1)
        balance = max(balance, 0.0)
    provision = max(balance - (loan["recoveries"] or 0), 0) if status == "defaulted" else 0.0
    return status, dpd, balance, provision


def loans(seed, n):
    rng = random.Random(seed)
    states = [*DEFAULTED, *SETTLED, "Current", "Late (31-120 days)"]
    made = []
    for i in range(n):
        issue = date(2016, 1, 1) + timedelta(days=rng.randrange(1000))
        issue = issue.replace(day=1)
        paid = None
        if rng.random() < 0.8:
            # Some payments precede the issue or fall after every snapshot.
            paid = issue + timedelta(days=rng.randrange(-60, 1100))
        made.append({
            **MASTER_ROW, "exposure_id": f"LC-{i}", "issue_d": issue, "last_pymnt_d": paid,
            "loan_status": rng.choice(states), "loan_amnt": float(rng.randrange(1000, 40000)),
            "int_rate": rng.choice([0.0, 7.5, 12.0, 21.3, None]),
            "term_months": rng.choice([36, 60]), "recoveries": rng.choice([None, 0.0, 500.0]),
        })
    return made


@pytest.mark.parametrize("freq, start, end", [
    (MONTH_END, date(2018, 1, 31), date(2018, 12, 31)),
    (DAILY, date(2018, 11, 20), date(2018, 12, 10)),
])
def test_every_position_matches_the_rules(spark, freq, start, end):
    book = loans(3, 300)
    df = spark.createDataFrame(book, MASTER)
    got = {
        (r["exposure_id"], r["snapshot_date"]): r
        for r in positions(df, date_spine(start, end, freq)).collect()
    }
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    if freq == MONTH_END:
        days = [d for d in days if (d + timedelta(days=1)).day == 1]
    seen = 0
    for loan in book:
        for snap in days:
            want, row = expected(loan, snap), got.get((loan["exposure_id"], snap))
            if want is None:
                assert row is None, (loan, snap)
                continue
            seen += 1
            assert row is not None, (loan, snap)
            assert (row["status"], row["days_past_due"]) == want[:2]
            assert row["outstanding_amount"] == pytest.approx(want[2], abs=1e-6)
            assert row["provision_amount"] == pytest.approx(want[3], abs=1e-6)
            assert row["default_flag"] == (want[0] == "defaulted")
    assert seen == len(got) > 500


def test_one_job_over_dates_equals_one_job_per_date(spark):
    df = spark.createDataFrame(loans(5, 120), MASTER)
    together = positions(df, date_spine("2018-03-31", "2018-06-30", MONTH_END))
    apart = None
    for d in ("2018-03-31", "2018-04-30", "2018-05-31", "2018-06-30"):
        one = portfolio_as_of(df, d)
        apart = one if apart is None else apart.unionByName(one)
    assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()


def test_charged_off_without_a_payment_stays_performing(spark):
    row = portfolio_as_of(master(spark, {"loan_status": "Charged Off"}), "2018-12-31").first()
    assert (row["status"], row["days_past_due"]) == ("performing", 0)


def test_retention_keeps_exits_for_thirty_days(spark):
    df = master(spark, {"loan_status": "Fully Paid", "last_pymnt_d": date(2018, 11, 15)})
    dates = date_spine("2018-11-30", "2018-12-31", DAILY)
    rows = positions(df, dates).orderBy("snapshot_date").collect()
    assert rows[0]["status"] == "performing"
    assert rows[1]["status"] == "closed" and rows[1]["outstanding_amount"] == 0.0
    assert rows[-1]["snapshot_date"] == date(2018, 12, 15)


@pytest.mark.parametrize("rate, n, m, want", [
    (0.0, 36, 18, 500.0), (12.0, 36, 0, 1000.0), (12.0, 36, 36, 0.0), (12.0, 36, 99, 0.0),
    (12.0, 36, -3, 1000.0), (0.0, 0, 5, 1000.0), (None, 36, 3, 0.0), (float("nan"), 36, 3, 0.0),
])
def test_amortised_balance(spark, rate, n, m, want):
    df = spark.createDataFrame([(1000.0, rate, n, m)], "p double, r double, n int, m int")
    cols = [F.col(c) for c in "prnm"]
    assert df.select(amortised_balance(*cols)).first()[0] == pytest.approx(want, abs=1e-9)


def test_calendar_months_ignore_the_day(spark):
    df = spark.createDataFrame([(date(2018, 1, 31), date(2018, 2, 1))], "a date, b date")
    assert df.select(calendar_months(F.col("a"), F.col("b"))).first()[0] == 1


def test_month_end_spine(spark):
    def spine(*args):
        return spark.range(1).select(date_spine(*args)).first()[0]

    assert spine("2018-01-15", "2018-04-29", MONTH_END) == [
        date(2018, 1, 31), date(2018, 2, 28), date(2018, 3, 31)
    ]
    assert spine("2016-02-29", "2016-02-29", MONTH_END) == [date(2016, 2, 29)]
    assert spine("2018-12-30", "2019-01-01", DAILY) == [
        date(2018, 12, 30), date(2018, 12, 31), date(2019, 1, 1)
    ]
    with pytest.raises(ValueError):
        date_spine("2018-01-01", "2018-02-01", "W")


def test_month_year(spark):
    texts = ["Dec-2018", "dec-2018", "13-2018", "December-2018", "", None, "n/a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(month_year(F.col("t"))).collect()] == [
        date(2018, 12, 1), date(2018, 12, 1), None, None, None, None, None
    ]


def test_loan_master_rejects_and_counts(spark):
    schema = raw_schema(["id", "issue_d", "term", "loan_amnt", "last_pymnt_d", "loan_status"])
    raw = spark.createDataFrame(
        [
            ("1077", "Dec-2018", " 36 months", 5000.0, "Jan-2019", "Current"),
            ("1078", "bad", " 60 months", 5000.0, None, "Current"),
            ("Total amount: 5", "Dec-2018", "", 0.0, None, None),
            (None, "Dec-2018", None, None, None, None),
            ("12\n", "Dec-2018", None, None, None, None),
            ("1079", "Jan-2017", "none", 1.0, "x", "Current"),
        ],
        schema,
    )
    with pytest.raises(ValueError, match="annual_inc"):
        loan_master(raw)
    raw = raw.select(*[
        F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in raw_schema()
    ])
    kept = {r["id"]: r for r in loan_master(raw).collect()}
    assert set(kept) == {"1077", "1079"}
    assert kept["1077"]["term_months"] == 36 and kept["1079"]["term_months"] is None
    assert kept["1077"]["exposure_id"] == "LC-1077"
    assert kept["1077"]["last_pymnt_d"] == date(2019, 1, 1)
    assert kept["1079"]["last_pymnt_d"] is None
    counts = loan_rejects(raw).first()
    assert counts.asDict() == {
        "rows_read": 6, "rejected_key": 3, "rejected_issue_date": 1, "rows_kept": 2
    }


def test_metrics_of_a_book(spark):
    book = spark.createDataFrame(
        [("d", "performing", 100.0, 0.0), ("d", "defaulted", 25.0, 20.0), ("d", "closed", 0.0, 0.0),
         ("e", "closed", 0.0, 0.0)],
        "snapshot_date string, status string, outstanding_amount double, provision_amount double",
    )
    rows = {r["snapshot_date"]: r for r in portfolio_metrics(book).collect()}
    assert rows["d"]["npl_pct"] == 20.0 and rows["d"]["row_count"] == 3
    assert rows["d"]["live_balance"] == 125.0 and rows["d"]["total_provision"] == 20.0
    assert rows["e"]["npl_pct"] == 0.0
