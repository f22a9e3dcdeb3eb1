"""Transaction-monitoring jobs: alerts, screening, and the stream from message to silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.detection import (
    DRAIN, STRUCTURING, SWEEP, VELOCITY, build_alerts,
)
from ledgerlens.operators.screening import THRESHOLD, attach_matches, match_names
from ledgerlens.session import scratch_path
from ledgerlens.sources.files import children, remove, write_partitions
from ledgerlens.streaming.bronze import BRONZE, parse, run_bronze, start_append
from ledgerlens.streaming.silver import bronze_stream, run_silver, start_silver

ALL_RULES = (SWEEP, DRAIN, VELOCITY, STRUCTURING)


def write_alerts(alerts: DataFrame, root: str, rules: Sequence[str]) -> None:
    """Replace the alerts of the given rules, partitioned by rule.

    The rules run once, into a staging table. A rule that found nothing this time is
    cleared: its old alerts must not outlive the run that no longer raises them.
    """
    spark = alerts.sparkSession
    staged = scratch_path(spark, "alerts")
    alerts.write.partitionBy("rule").parquet(staged)
    raised = {name.removeprefix("rule=") for name in children(spark, staged)}
    if raised & set(rules):
        write_partitions(spark.read.parquet(staged), root, "rule")
    for rule in set(rules) - raised:
        remove(spark, f"{root.rstrip('/')}/rule={rule}")
    remove(spark, staged)


def run_alerts(
    silver: DataFrame, root: str, rules: Sequence[str] = (SWEEP,), **limits
) -> int:
    """Raise alerts over all of silver; returns how many the table now holds for the rules."""
    write_alerts(build_alerts(silver, rules, **limits), root, rules)
    spark = silver.sparkSession
    if not any(name.startswith("rule=") for name in children(spark, root)):
        return 0
    stored = spark.read.parquet(root)
    return stored.filter(stored["rule"].isin(*rules)).count()


def run_screening(
    dest_names: DataFrame, watchlist: DataFrame, path: str, threshold: float = THRESHOLD
) -> int:
    """Screen all destinations; returns the number of hits stored.

    The matched names are stored first. Their size is then known, so that a small result is
    broadcast and the destinations are not shuffled to meet it.
    """
    spark = dest_names.sparkSession
    staged = scratch_path(spark, "matches")
    match_names(dest_names, watchlist, threshold).write.parquet(staged)
    attach_matches(dest_names, spark.read.parquet(staged)).write.mode("overwrite").parquet(path)
    remove(spark, staged)
    return spark.read.parquet(path).count()


def run_stream(spark: SparkSession, messages: DataFrame, root: str) -> None:
    """What has arrived, to bronze and on to silver, each with its own checkpoint; then stop."""
    run_bronze(messages, f"{root}/bronze", f"{root}/checkpoints/bronze")
    run_silver(
        bronze_stream(spark, f"{root}/bronze", BRONZE), f"{root}/silver", f"{root}/quarantine",
        f"{root}/checkpoints/silver",
    )


def start_stream(
    spark: SparkSession, messages: DataFrame, root: str
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both stages side by side, until stopped."""
    bronze = start_append(
        parse(messages), f"{root}/bronze", f"{root}/checkpoints/bronze", once=False
    )
    silver = start_silver(
        bronze_stream(spark, f"{root}/bronze", BRONZE), f"{root}/silver", f"{root}/quarantine",
        f"{root}/checkpoints/silver", once=False,
    )
    return bronze, silver
