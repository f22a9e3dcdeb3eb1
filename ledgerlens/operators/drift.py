"""Period-over-period drift: moves too large to pass unexplained, and no move at all."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

TOLERANCE = 0.25
UNCHANGED, DRIFT = "unchanged", "drift"


def _as_values(measures: Mapping[str, Column]) -> list[Column]:
    return [
        F.coalesce(value.cast("double"), F.lit(0.0)).alias(name)
        for name, value in measures.items()
    ]


def measure(df: DataFrame, measures: Mapping[str, Column]) -> dict[str, float]:
    """One number per measure, from one aggregate; an absent number counts as zero."""
    return df.agg(*_as_values(measures)).first().asDict()


def period_measures(
    df: DataFrame, period: str, measures: Mapping[str, Column]
) -> DataFrame:
    """Every period's measures from one aggregate, long: `period, measure, value`."""
    return (
        df.groupBy(period)
        .agg(*_as_values(measures))
        .unpivot([period], list(measures), "measure", "value")
        .withColumnRenamed(period, "period")
    )


def period_drift(measured: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Each measure beside its value in the period before, with `ratio` and `kind`.

    Runs on measures, not on data: one row per period and measure. The first period has
    nothing before it and is left out.
    """
    order = Window.partitionBy("measure").orderBy("period")
    before, after = F.col("previous"), F.col("current")
    ratio = F.when(before == 0, F.lit(float("inf"))).otherwise(
        after / F.nullif(before, F.lit(0.0))
    )
    return (
        measured.withColumn("previous", F.lag("value").over(order))
        .withColumn("previous_period", F.lag("period").over(order))
        .filter(F.col("previous_period").isNotNull())
        .withColumnRenamed("value", "current")
        .withColumn("ratio", ratio)
        .withColumn(
            "kind",
            F.when(before == after, UNCHANGED).when(
                (before == 0) | (F.abs(F.col("ratio") - F.lit(1.0)) > F.lit(tolerance)), DRIFT
            ),
        )
        .select("measure", "previous_period", "period", "previous", "current", "ratio", "kind")
    )


def period_breaches(measured: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Only the moves worth explaining, each with its text."""
    text = F.when(
        F.col("kind") == UNCHANGED,
        F.format_string("%s: unchanged at %,.2f", "measure", "current"),
    ).otherwise(
        F.concat(
            F.format_string("%s: %,.2f -> %,.2f (", "measure", "previous", "current"),
            F.when(F.col("previous") == 0, "inf").otherwise(
                F.format_string("%,.2f", "ratio")
            ),
            F.lit("x)"),
        )
    )
    return (
        period_drift(measured, tolerance)
        .filter(F.col("kind").isNotNull())
        .withColumn("text", text)
    )
