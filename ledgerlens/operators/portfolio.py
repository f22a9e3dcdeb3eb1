"""Portfolio positions as of any number of dates, derived from the loan master."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.dates import as_date
from ledgerlens.functions.finance import amortised_balance, calendar_months

# Lifecycle limits in days and the final states that end a loan.
DEFAULT_AT_DPD = 90
WRITE_OFF_AT_DPD = 180
RETENTION_DAYS = 30
DEFAULTED_FINAL = [
    "Charged Off", "Default", "Does not meet the credit policy. Status:Charged Off",
]
SETTLED_FINAL = ["Fully Paid", "Does not meet the credit policy. Status:Fully Paid"]


def _last_date_on_book() -> Column:
    """A date after which a loan is certainly off the book; null where there is none.

    Only a bound that saves generating rows: the exact retention rule still runs on every
    row that is generated. A loan that ended with a payment on or after its issue leaves
    within the retention after that payment, or after the write-off it leads to.
    """
    ended_with_payment = F.col("last_pymnt_d") >= F.col("issue_d")
    status = F.col("loan_status")
    return F.when(
        ended_with_payment & status.isin(SETTLED_FINAL),
        F.date_add("last_pymnt_d", RETENTION_DAYS),
    ).when(
        ended_with_payment & status.isin(DEFAULTED_FINAL),
        F.date_add("last_pymnt_d", WRITE_OFF_AT_DPD + RETENTION_DAYS),
    )


def positions(master: DataFrame, dates: Column) -> DataFrame:
    """The book on each date of the array `dates`, in one narrow pass over the master.

    Each loan is expanded only to the dates it can be on the book, so there is neither a join
    nor a shuffle and the work follows the number of live positions.
    """
    off_book = _last_date_on_book()
    alive = F.filter(
        dates,
        lambda d: (d >= F.col("issue_d")) & F.coalesce(d <= off_book, F.lit(True)),
    )
    snap, issued, paid = F.col("snapshot_date"), F.col("issue_d"), F.col("last_pymnt_d")

    aged = master.withColumn("snapshot_date", F.explode(alive)).withColumns({
        "_m": calendar_months(issued, snap),
        "_defaulted": F.coalesce(F.col("loan_status").isin(DEFAULTED_FINAL), F.lit(False)),
        "_settled": F.coalesce(F.col("loan_status").isin(SETTLED_FINAL), F.lit(False)),
        "_days": F.coalesce(F.datediff(snap, paid), F.lit(0)),
    }).withColumn(
        "_paid_m",
        F.greatest(
            F.col("_m") - calendar_months(F.coalesce(paid, issued), snap), F.lit(0)
        ),
    ).withColumn("_stopped", F.col("_m") > F.col("_paid_m"))

    staged = aged.withColumn(
        "days_past_due",
        F.when(
            F.col("_defaulted") & F.col("_stopped"), F.greatest(F.col("_days"), F.lit(0))
        ).otherwise(F.lit(0)),
    ).withColumn(
        "status",
        F.when(F.col("_settled") & F.col("_stopped"), "closed")
        .when(F.col("days_past_due") >= WRITE_OFF_AT_DPD, "written_off")
        .when(F.col("days_past_due") >= DEFAULT_AT_DPD, "defaulted")
        .when(F.col("days_past_due") > 0, "past_due")
        .otherwise("performing"),
    )

    # A loan that is both carries its write-off age, as the feed reports it.
    written_off = F.col("days_past_due") >= WRITE_OFF_AT_DPD
    closed = F.col("_settled") & F.col("_stopped")
    exit_age = F.when(written_off, F.col("days_past_due") - WRITE_OFF_AT_DPD).when(
        closed, F.col("_days")
    )
    on_book = staged.filter(F.coalesce(exit_age, F.lit(0)) <= RETENTION_DAYS)

    final = F.col("_defaulted") | F.col("_settled")
    balance = F.when(written_off | closed, F.lit(0.0)).otherwise(
        amortised_balance(
            F.col("loan_amnt"),
            F.col("int_rate"),
            F.col("term_months"),
            F.when(final, F.least(F.col("_m"), F.col("_paid_m"))).otherwise(F.col("_m")),
        )
    )
    valued = on_book.withColumn("outstanding_amount", balance)
    provision = F.when(
        F.col("status") == "defaulted",
        F.greatest(
            F.col("outstanding_amount") - F.coalesce("recoveries", F.lit(0.0)), F.lit(0.0)
        ),
    ).otherwise(F.lit(0.0))
    # The derived values leave through a generator. Filters on them then read a value; without
    # it the optimizer would push every later rule below this projection and repeat the whole
    # lifecycle and balance arithmetic inside each of its conditions.
    derived = F.struct(
        "outstanding_amount", "status", "days_past_due",
        (F.col("status") == "defaulted").alias("default_flag"),
        provision.alias("provision_amount"),
    )
    return valued.select(
        *master.columns, "snapshot_date", F.inline(F.array(derived))
    ).select(
        *master.columns, "outstanding_amount", "status", "days_past_due", "default_flag",
        "provision_amount", "snapshot_date",
    )


def portfolio_as_of(master: DataFrame, snapshot: str | date) -> DataFrame:
    """The book on one date."""
    return positions(master, F.array(as_date(snapshot)))


def portfolio_metrics(book: DataFrame, date_column: str = "snapshot_date") -> DataFrame:
    """The month-end series a book is judged by, one row per date."""
    amount, status = F.col("outstanding_amount"), F.col("status")

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    return (
        book.groupBy(date_column)
        .agg(
            F.count("*").alias("row_count"),
            total(amount > 0, amount).alias("live_balance"),
            F.count_if(status == "performing").alias("performing"),
            F.count_if(status == "past_due").alias("past_due"),
            F.count_if(status == "defaulted").alias("defaulted"),
            total(status == "defaulted", amount).alias("_defaulted_balance"),
            total(F.lit(True), F.col("provision_amount")).alias("total_provision"),
        )
        .withColumn(
            "npl_pct",
            F.col("_defaulted_balance").cast("double")
            / F.greatest(F.col("live_balance").cast("double"), F.lit(1.0)) * 100,
        )
        .drop("_defaulted_balance")
    )
