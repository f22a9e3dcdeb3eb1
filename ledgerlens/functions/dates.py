"""Event time, calendar spines and date parsing."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

REFERENCE_DATE = "2018-01-01"
DAILY, MONTH_END = "D", "ME"


def as_date(value: str | date | Column) -> Column:
    """A date literal from text or a date; a Column passes through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(value).cast("date")


def event_time(step: Column | None = None, reference: str = REFERENCE_DATE) -> Column:
    """The timestamp `step` hours after the reference date."""
    step = F.col("step") if step is None else step
    return F.lit(reference).cast("timestamp") + F.make_dt_interval(hours=step)


def step_of(moment: Column, reference: str = REFERENCE_DATE) -> Column:
    """The hourly step a timestamp falls in; the inverse of `event_time`."""
    seconds = F.unix_timestamp(moment) - F.unix_timestamp(F.lit(reference).cast("timestamp"))
    return F.floor(seconds / 3600).cast("int")


def date_spine(start: str | date, end: str | date, freq: str = DAILY) -> Column:
    """An array of every day, or of every month-end, from `start` to `end` inclusive.

    Built from literals only, so Catalyst folds it to a constant. Its length is the number
    of reporting dates asked for, never a function of the data.
    """
    first, last = as_date(start), as_date(end)
    if freq == DAILY:
        return F.sequence(first, last, F.expr("interval 1 day"))
    if freq != MONTH_END:
        raise ValueError(f"freq must be {DAILY!r} or {MONTH_END!r}, not {freq!r}")
    # Months added to a 31st land on the last day of every month. The series starts at the
    # end of the year before, and its first elements up to the month before `start` go.
    year_end = F.make_date(F.year(first) - 1, F.lit(12), F.lit(31))
    series = F.sequence(year_end, last, F.expr("interval 1 month"))
    return F.slice(series, F.month(first) + 1, F.greatest(F.size(series), F.lit(0)))


def month_year(text: Column) -> Column:
    """`Dec-2018` to 2018-12-01; null where the text is anything else."""
    return F.try_to_date(F.concat(F.lit("01-"), F.initcap(text)), "dd-MMM-yyyy")
