"""Risk-weighted assets per exposure, and reconciliation of what came back with what went in."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from ledgerlens.contracts import ContractViolation
from ledgerlens.functions.finance import (
    CAPITAL_RATIO, DEFAULTED_WEIGHT, MONEY, RISK_WEIGHT, exposure_at_default, risk_weight,
)

EAD_TOLERANCE = Decimal("1")


def run_engine(
    engine_input: DataFrame,
    weights: Mapping[str, Decimal] = RISK_WEIGHT,
    defaulted_weight: Decimal = DEFAULTED_WEIGHT,
    capital_ratio: Decimal = CAPITAL_RATIO,
) -> DataFrame:
    """RWA and capital per exposure, in exact decimal arithmetic and without a shuffle."""
    ead = exposure_at_default()
    weight = risk_weight(weights=weights, defaulted_weight=defaulted_weight)
    return engine_input.select(
        "reporting_date", "exposure_id", "customer_id", "rating_grade", "status",
        ead.alias("ead"),
        weight.alias("risk_weight"),
        (ead * weight).cast(MONEY).alias("rwa"),
        (ead * weight * F.lit(capital_ratio)).cast(MONEY).alias("capital_required"),
    )


def total_rwa(output: DataFrame) -> DataFrame:
    return output.agg(F.coalesce(F.sum("rwa"), F.lit(0).cast(MONEY)).alias("total_rwa"))


def reconciliation_totals(engine_input: DataFrame, engine_output: DataFrame) -> DataFrame:
    """One row: counts and EAD on both sides, from one job with two map-side aggregates."""
    sent = engine_input.select(
        F.lit("sent").alias("side"), exposure_at_default().alias("ead")
    )
    returned = engine_output.select(F.lit("returned").alias("side"), "ead")
    side = F.col("side")

    def ead_of(name: str):
        return F.coalesce(F.sum(F.when(side == name, F.col("ead"))), F.lit(0))

    return sent.unionByName(returned).agg(
        F.count_if(side == "sent").alias("sent_count"),
        F.count_if(side == "returned").alias("returned_count"),
        ead_of("sent").alias("sent_ead"),
        ead_of("returned").alias("returned_ead"),
    )


def reconcile(
    engine_input: DataFrame, engine_output: DataFrame, reporting_date: str | date
) -> None:
    """Raise unless count and total EAD returned are those that were sent."""
    compare_totals(reconciliation_totals(engine_input, engine_output).first().asDict(), reporting_date)


def compare_totals(totals: Mapping[str, object], reporting_date: str | date) -> None:
    """Raise unless the counts and EAD of both sides agree, as `reconciliation_totals` names
    them."""
    # The message texts.
    if totals["sent_count"] != totals["returned_count"]:
        raise ContractViolation(
            f"{reporting_date}: sent {totals['sent_count']} exposures, "
            f"engine returned {totals['returned_count']}"
        )
    if abs(totals["sent_ead"] - totals["returned_ead"]) > EAD_TOLERANCE:
        raise ContractViolation(
            f"{reporting_date}: EAD sent {totals['sent_ead']} "
            f"!= EAD returned {totals['returned_ead']}"
        )


def reconciliation_breaks(
    engine_input: DataFrame, engine_output: DataFrame, tolerance: Decimal = Decimal("0")
) -> DataFrame:
    """The exposures behind a difference: dropped, invented or distorted.

    Equal totals can hide errors that cancel; this compares exposure for exposure. One
    full-outer equi-join on the grain, three columns wide.
    """
    key = ["reporting_date", "exposure_id"]
    sent = engine_input.select(*key, exposure_at_default().alias("ead_sent"))
    returned = engine_output.select(*key, F.col("ead").alias("ead_returned"))
    difference = F.col("ead_sent") - F.col("ead_returned")
    in_sent, in_returned = F.col("_sent").isNotNull(), F.col("_returned").isNotNull()
    kind = (
        F.when(~in_returned, "dropped")
        .when(~in_sent, "invented")
        .when(
            (F.abs(difference) > F.lit(tolerance))
            | (F.col("ead_sent").isNull() != F.col("ead_returned").isNull()),
            "distorted",
        )
    )
    return (
        sent.withColumn("_sent", F.lit(True))
        .join(returned.withColumn("_returned", F.lit(True)), key, "full_outer")
        .withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .select(*key, "kind", "ead_sent", "ead_returned")
    )
