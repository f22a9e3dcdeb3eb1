"""Reporting models and the queries an investigation starts from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.contracts.contract import FAILED
from ledgerlens.functions.dates import DAILY, date_spine


def _ratio(numerator, denominator):
    """Four-decimal ratio in decimal arithmetic, null over nothing."""
    return F.round(
        numerator.cast("decimal(28,2)") / F.nullif(
            denominator.cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)")
        ), 4
    ).cast("decimal(18,4)")


def rwa_monthly_trend(output: DataFrame) -> DataFrame:
    """Exposure, RWA, capital and average risk weight per reporting date."""
    return (
        output.groupBy("reporting_date")
        .agg(
            F.count("*").alias("exposure_count"),
            F.sum("ead").alias("total_ead"),
            F.sum("rwa").alias("total_rwa"),
            F.sum("capital_required").alias("total_capital"),
            _ratio(F.sum("rwa"), F.sum("ead")).alias("avg_risk_weight"),
        )
        .orderBy("reporting_date")
    )


def latest_slice(df: DataFrame, date_column: str) -> DataFrame:
    """The rows of the latest date.

    The date is a scalar subquery: over a table partitioned by it, only its column is read
    to find it and only one partition is read for the rows.
    """
    return df.filter(F.col(date_column) == df.select(F.max(date_column)).scalar())


def latest_groups(df: DataFrame, date_column: str, group: str, measures: Mapping[str, Column]) -> DataFrame:
    """The measures per group on the latest date of all, from one reading of the rows.

    Rows combine map-side per date and group; of these few rows each group keeps its latest
    one, and of those the groups that have the latest date remain. Where the rows are a table
    partitioned by the date, `latest_slice` reads less.
    """
    per_date = df.groupBy(date_column, group).agg(*[m.alias(n) for n, m in measures.items()])
    latest = per_date.groupBy(group).agg(
        F.max(date_column).alias(date_column), F.max_by(F.struct(*measures), date_column).alias("_m"))
    # One row a group.
    of_all = F.max(date_column).over(Window.partitionBy(F.lit(0)))
    return latest.withColumn("_latest", of_all).where(F.col(date_column) == F.col("_latest")).select(
        date_column, group, "_m.*")


def capital_by_grade(output: DataFrame) -> DataFrame:
    """Where capital concentrates across grades on the latest reporting date."""
    return latest_groups(output, "reporting_date", "rating_grade", {
        "exposure_count": F.count("*"),
        "total_ead": F.sum("ead"),
        "total_rwa": F.sum("rwa"),
        "total_capital": F.sum("capital_required"),
    }).orderBy("rating_grade")


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("rule")
        .agg(
            F.count("*").alias("alert_count"),
            F.sum("label").alias("true_fraud"),
            _ratio(F.sum("label"), F.count("*")).alias("precision"),
        )
        .orderBy(F.desc("alert_count"), "rule")
    )


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("type")
        .agg(
            F.count("*").alias("alert_count"),
            F.sum("label").alias("true_fraud"),
            F.sum("amount").alias("total_amount"),
            F.round(F.avg("amount"), 2).cast("decimal(18,2)").alias("avg_amount"),
        )
        .orderBy(F.desc("alert_count"), "type")
    )


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys carried by more than one row. Copies are counted before the shuffle."""
    return df.groupBy(*grain).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def quarantine_by_combination(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per combination of broken rules, most frequent first."""
    return (
        quarantined.groupBy(FAILED)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), FAILED)
    )


def quarantine_by_rule(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per broken rule; a row counts under each rule it broke.

    Rows are counted per combination first: there are few combinations, so the explode runs
    on a handful of rows.
    """
    return (
        quarantined.groupBy(FAILED)
        .agg(F.count("*").alias("n"))
        .select(F.explode(FAILED).alias("rule"), "n")
        .groupBy("rule")
        .agg(F.sum("n").alias("row_count"))
        .orderBy(F.desc("row_count"), "rule")
    )


def quarantine_by_size(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per number of broken rules, most broken first."""
    return (
        quarantined.groupBy(F.size(FAILED).alias("broken"))
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("broken"))
    )


def arrival_gaps(
    df: DataFrame, date_column: str, start: str | date, end: str | date, freq: str = DAILY
) -> DataFrame:
    """Rows per expected date; a date that never arrived shows zero."""
    spine = df.sparkSession.range(1).select(
        F.explode(date_spine(start, end, freq)).alias(date_column)
    )
    arrived = (
        df.filter(F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy(date_column)
        .agg(F.count("*").alias("n"))
    )
    return spine.join(arrived, date_column, "left").select(
        date_column, F.coalesce("n", F.lit(0)).alias("row_count")
    )
