"""Credit-risk jobs: snapshots, silver, engine input, RWA. Each replaces one date's slice.

A job that checks a contract evaluates its rows once, into a staging table split by outcome,
and works from there: quarantine first, so the evidence exists when an assertion halts the
job, then the assertions, then the publication. Counts and totals are observed while the rows
are staged; of the stored rows only the key columns are read to check the grain, and all of
them to publish. What is published is what was checked, and a lost executor costs the staged
files nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ledgerlens.contracts import Contract
from ledgerlens.contracts.contract import FAILED, broken_rules
from ledgerlens.functions.dates import DAILY, MONTH_END, date_spine
from ledgerlens.functions.finance import exposure_at_default
from ledgerlens.operators import engine_input, exposure, rwa
from ledgerlens.operators.loans import loan_master, reject_counts
from ledgerlens.operators.portfolio import positions
from ledgerlens.session import scratch_path
from ledgerlens.sources.files import (
    read_partition, remove, replace_partition, write_partitions,
)

INPUT_CONTRACT = "credit_risk_exposure_input"
OUTPUT_CONTRACT = "credit_risk_rwa_output"


@dataclass(frozen=True)
class Outcome:
    published: int
    quarantined: int
    total_rwa: Decimal | None = None

    @property
    def quarantined_pct(self) -> float:
        rows = self.published + self.quarantined
        return self.quarantined / rows * 100 if rows else 0.0


class Staged:
    """Tagged rows stored once, split by outcome; counts and `totals` (aggregates over the rows
    that passed) are observed by the job that stores them."""

    def __init__(self, tagged: DataFrame, purpose: str, totals: Mapping[str, Column] | None = None):
        self.spark = tagged.sparkSession
        self.path = scratch_path(self.spark, purpose)
        broken, seen = F.col("_broken"), Observation(purpose)
        measures = [F.count_if(~broken).alias("_kept"), F.count_if(broken).alias("_dropped")]
        measures += [F.sum(F.when(~broken, column)).alias(name) for name, column in (totals or {}).items()]
        tagged.withColumn("_broken", F.size(FAILED) > 0).observe(seen, *measures).write.partitionBy(
            "_broken").parquet(self.path)
        self.seen = seen.get
        # Declared, because an empty dataset leaves no file to read a schema from.
        self.schema = StructType([*tagged.schema.fields, StructField("_broken", BooleanType())])

    def _rows(self, broken: bool) -> DataFrame:
        stored = self.spark.read.schema(self.schema).parquet(self.path)
        return stored.filter(F.col("_broken") == F.lit(broken)).drop("_broken")

    @property
    def passed(self) -> DataFrame:
        return self._rows(False).drop(FAILED)

    @property
    def quarantined(self) -> DataFrame:
        return self._rows(True)

    def counts(self) -> tuple[int, int]:
        """Rows that passed and rows that did not; a dataset without partitions observes none."""
        return self.seen.get("_kept") or 0, self.seen.get("_dropped") or 0

    def total(self, name: str) -> Decimal:
        return self.seen.get(name) or Decimal(0)

    def drop(self) -> None:
        remove(self.spark, self.path)


def build_master(raw: DataFrame, path: str) -> dict[str, int]:
    """Write the master; returns what was read, kept and rejected, observed on the way."""
    seen = Observation("master")
    loan_master(raw.observe(seen, *reject_counts())).write.mode("overwrite").parquet(path)
    return seen.get


def build_snapshots(
    master: DataFrame, root: str, start: str | date, end: str | date, freq: str = MONTH_END
) -> None:
    """All snapshot partitions of a date range from one job.

    A few month-ends are written straight from the tasks that made them; a daily range
    would give every task a file per day, so its rows are gathered by date first.
    """
    book = positions(master, date_spine(start, end, freq))
    write_partitions(book, root, "snapshot_date", rebalance=freq == DAILY)


def run_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, quarantine_root: str,
    snapshot: str,
) -> Outcome:
    """Conform and validate one snapshot. Silver has no dataset assertions."""
    landed = read_partition(spark, bronze_root, snapshot)
    tagged = exposure.conform(landed, "snapshot_date").withColumn(
        FAILED, broken_rules(exposure.rules())
    )
    staged = Staged(tagged, "silver-exposure")
    try:
        kept, dropped = staged.counts()
        replace_partition(
            staged.quarantined, quarantine_root, "snapshot_date", snapshot,
            known_empty=dropped == 0,
        )
        replace_partition(
            staged.passed, silver_root, "snapshot_date", snapshot, known_empty=kept == 0
        )
        return Outcome(kept, dropped)
    finally:
        staged.drop()


def _publish(
    contract: Contract, staged: Staged, target: str, quarantine: str, reporting_date: str,
    check=None,
) -> tuple[int, int]:
    """Quarantine, then assert, then publish. Raising leaves the published slice as it was."""
    kept, dropped = staged.counts()
    replace_partition(
        staged.quarantined, quarantine, "reporting_date", reporting_date,
        known_empty=dropped == 0,
    )
    contract.assert_counted(kept, dropped, staged.passed)
    if check:
        check()
    replace_partition(
        staged.passed, target, "reporting_date", reporting_date, known_empty=kept == 0
    )
    return kept, dropped


def run_engine_input(
    spark: SparkSession, silver_root: str, target_root: str, quarantine_root: str,
    reporting_date: str,
) -> Outcome:
    """Publish the exposures in scope for a reporting date, if the dataset is fit."""
    contract = Contract.named(INPUT_CONTRACT)
    book = read_partition(spark, silver_root, reporting_date)
    staged = Staged(contract.tag(engine_input.build(book, reporting_date)), "engine-input")
    try:
        return Outcome(*_publish(contract, staged, target_root, quarantine_root, reporting_date))
    finally:
        staged.drop()


def run_rwa(
    spark: SparkSession, input_root: str, target_root: str, quarantine_root: str,
    reporting_date: str, weights=None,
) -> Outcome:
    """Calculate, check and reconcile RWA for a reporting date, then publish it."""
    contract = Contract.named(OUTPUT_CONTRACT)
    sent = read_partition(spark, input_root, reporting_date, "reporting_date")
    # What was sent is counted on its way into the engine.
    seen = Observation("sent")
    counted = sent.observe(
        seen, F.count("*").alias("sent_count"), F.sum(exposure_at_default()).alias("sent_ead"))
    calculated = rwa.run_engine(counted, **({"weights": weights} if weights else {}))
    staged = Staged(contract.tag(calculated), "rwa-output", {"ead": F.col("ead"), "rwa": F.col("rwa")})
    try:
        totals = {
            "sent_count": seen.get.get("sent_count") or 0, "sent_ead": seen.get.get("sent_ead") or Decimal(0),
            "returned_count": staged.counts()[0], "returned_ead": staged.total("ead"),
        }
        kept, dropped = _publish(
            contract, staged, target_root, quarantine_root, reporting_date,
            check=lambda: rwa.compare_totals(totals, reporting_date),
        )
        return Outcome(kept, dropped, staged.total("rwa"))
    finally:
        staged.drop()
