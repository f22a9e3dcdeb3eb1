"""Versioned rows, and what keeping their history costs.

A versioned dataset only appends: replacing a partition writes its rows under a higher
`version`. The current table, any earlier state, and the storage held by history are then
plain queries over the version numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

RETENTION_DAYS = 30
RETAIN_LAST = 5


def validity(df: DataFrame, partition: Sequence[str], column: str = "version") -> DataFrame:
    """Per partition and version the first later version, at which it stops being current.

    The pairs collapse map-side; the window runs over the versions of a partition, not over
    its rows. Kept beside a table, this metadata spares an as-of read the look at its rows.
    """
    versions = Window.partitionBy(*partition).orderBy(column)
    return df.select(*partition, column).distinct().withColumn("valid_to", F.lead(column).over(versions))


def read_as_of(
    df: DataFrame, partition: Sequence[str], version: int | Column, column: str = "version",
    intervals: DataFrame | None = None,
) -> DataFrame:
    """The rows as they stood at a version: per partition its latest one not above it.

    `intervals` is the stored `validity`, and made from df where there is none. The partitions
    and versions current at the version meet the rows in a semi-join, whose strategy follows
    their size; where the table is partitioned by these columns, only their files are read.
    """
    intervals = validity(df, partition, column) if intervals is None else intervals
    current = intervals.filter(
        (F.col(column) <= version) & (F.col("valid_to").isNull() | (F.col("valid_to") > version))
    ).select(*partition, column)
    return df.filter(F.col(column) <= version).join(current, [*partition, column], "left_semi")


def storage_audit(
    files: DataFrame, commits: DataFrame, partition: Sequence[str], column: str = "version"
) -> DataFrame:
    """One row: snapshots, live and all files and bytes, what history holds and its share.

    `files` has one row per file with its partition, version and `bytes`; `commits` one row
    per snapshot.
    """
    per_version = files.groupBy(*partition, column).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
    # Per partition the live version is the latest one, so both totals come from one pass.
    per_partition = per_version.groupBy(*partition).agg(
        F.max_by(F.struct("files", "bytes"), column).alias("live"),
        F.sum("files").alias("all_files"),
        F.sum("bytes").alias("all_bytes"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    snapshots = commits.select(F.count("*")).scalar()
    live_bytes, all_bytes = F.col("live_bytes"), F.col("all_bytes")
    return (
        per_partition.agg(
            total("live.files").alias("live_files"),
            total("live.bytes").alias("live_bytes"),
            total("all_files").alias("all_files"),
            total("all_bytes").alias("all_bytes"),
        )
        .withColumn("snapshots", snapshots)
        .withColumn("held_by_history", all_bytes - live_bytes)
        .withColumn(
            "overhead_pct",
            F.try_divide(
                (all_bytes - live_bytes).cast("double") * 100, live_bytes.cast("double")
            ),
        )
        .select(
            "snapshots", "live_files", "live_bytes", "all_files", "all_bytes",
            "held_by_history", "overhead_pct",
        )
    )


def retention_plan(
    commits: DataFrame,
    as_of: datetime | str,
    older_than_days: int = RETENTION_DAYS,
    retain_last: int = RETAIN_LAST,
    committed_at: str = "committed_at",
) -> DataFrame:
    """How many snapshots a retention would drop, without dropping any."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(older_than_days))
    total = F.count("*")
    old = F.count_if(F.col(committed_at).cast("timestamp") < cutoff)
    return commits.agg(
        total.alias("snapshots"),
        old.alias("older_than_cutoff"),
        F.greatest(F.least(old, total - F.lit(retain_last)), F.lit(0)).alias("expirable"),
    )


def latest_commits(
    commits: DataFrame, n: int = 10, committed_at: str = "committed_at",
    tie_break: str = "version",
) -> DataFrame:
    """The last commits, newest first."""
    return commits.orderBy(F.desc(committed_at), F.desc(tie_break)).limit(n)
