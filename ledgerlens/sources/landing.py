"""Idempotent landing: load the snapshot partitions that differ from what has landed.

What has landed is told by a manifest beside the table: a count and a fingerprint of the rows
of each partition. Fingerprints of parts add up to that of the whole, so the manifest follows
an append without a look at the rows before it, and a rerun without change reads none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlens.functions.keys import fingerprint
from ledgerlens.sources.files import children, remove, write_partitions

# The outcomes reported per partition.
PRESENT, WOULD_LOAD, NEW, REPLACED = "present", "would load", "new", "replaced"


FINGERPRINT = ["row_count", "hash_sum", "hash_xor"]


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}_manifest"


def fingerprints(rows: DataFrame, partition: str) -> DataFrame:
    """Per partition the count and an order-free checksum of its rows."""
    return rows.groupBy(partition).agg(*fingerprint([c for c in rows.columns if c != partition]))


def merged(prints: DataFrame, partition: str) -> DataFrame:
    """Fingerprints of parts of partitions, added up."""
    return prints.groupBy(partition).agg(
        F.sum("row_count").alias("row_count"), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"))


def compared(mine: DataFrame, theirs: DataFrame | None, partition: str, force: bool = False) -> DataFrame:
    """Per partition of `mine` its row count and whether it is present, new or replaced."""
    if theirs is None:
        return mine.select(partition, "row_count", F.lit(NEW).alias("state"))
    landed = theirs.select(partition, F.struct(*FINGERPRINT).alias("landed"))
    same = F.struct(*FINGERPRINT) == F.col("landed")
    return mine.join(landed, partition, "left").select(
        partition,
        "row_count",
        F.when(F.col("landed").isNull(), NEW)
        .when(same & F.lit(not force), PRESENT)
        .otherwise(REPLACED)
        .alias("state"),
    )


def landing_plan(
    source: DataFrame, target: DataFrame | None, partition: str = "snapshot_date",
    force: bool = False,
) -> DataFrame:
    """`compared` for two tables of rows: one aggregate per side, so an interrupted landing
    resumes with what is missing and a changed partition is seen even where its size is the
    same."""
    theirs = None if target is None else fingerprints(target, partition)
    return compared(fingerprints(source, partition), theirs, partition, force)


@contextmanager
def staged(source: DataFrame, path: str, partition: str = "snapshot_date") -> Iterator[DataFrame]:
    """The source stored for the landings made from it, then removed.

    A landing reads its source twice, for the fingerprints and for the partitions that differ.
    One that takes work to make is made once here, and what lands is what was compared.
    """
    try:
        write_partitions(source, path, partition)
        # Declared, because text that looks like a date would be read as one.
        stored = source.sparkSession.read.schema(source.schema).parquet(path)
        yield stored.select(*source.columns)
    finally:
        remove(source.sparkSession, path)


def _landed(spark: SparkSession, root: str, partition: str, schema: StructType) -> DataFrame | None:
    """The fingerprints of what is stored. Two listings tell which partitions the manifest
    has; the others, landed before there was one, are read and noted in it."""
    manifest = manifest_path(root)
    stored, listed = ({n for n in children(spark, path) if n.startswith(f"{partition}=")} for path in (root, manifest))
    if not stored:
        return None
    if unlisted := sorted(stored - listed):
        rows = spark.read.option("basePath", root).parquet(*[f"{root}/{n}" for n in unlisted])
        write_partitions(fingerprints(rows, partition).coalesce(1), manifest, partition)
    return merged(spark.read.schema(schema).option("basePath", manifest).parquet(
        *[f"{manifest}/{n}" for n in sorted(stored)]), partition)


def land(
    spark: SparkSession, source: DataFrame, root: str, partition: str = "snapshot_date",
    only: str | None = None, force: bool = False, dry_run: bool = False,
) -> DataFrame:
    """Land the partitions that differ; returns what was (or would be) done to each.

    The source is read twice; `staged` keeps one that takes work to make.
    The fingerprints of the source have one row per partition. Those of partitions about to be
    replaced leave the manifest before their rows change, and come back after: a landing that
    breaks off in between is done again.
    """
    if only is not None:
        source = source.filter(F.col(partition) == F.lit(only).cast("date"))
    prints = fingerprints(source, partition)
    found = spark.createDataFrame(prints.collect(), prints.schema)
    plan = compared(found, _landed(spark, root, partition, prints.schema), partition, force)
    if dry_run:
        return plan.withColumn(
            "state", F.when(F.col("state") == PRESENT, PRESENT).otherwise(WOULD_LOAD)
        )
    # The outcome is fixed before the write changes what it is derived from.
    outcome = spark.createDataFrame(plan.collect(), plan.schema)
    wanted = outcome.filter(F.col("state") != PRESENT).select(partition)
    if names := [r[0] for r in wanted.collect()]:
        for name in names:
            remove(spark, f"{manifest_path(root)}/{partition}={name}")
        write_partitions(source.join(F.broadcast(wanted), partition, "left_semi"), root, partition)
        write_partitions(
            found.join(wanted, partition, "left_semi").coalesce(1), manifest_path(root), partition)
    return outcome
