"""Detection rules on a stream. The rules are the batch ones; only source and sink differ.

A windowed rule emits a window once the watermark has passed its end, and the watermark only
moves with later transactions: the last windows of a log that has ended would stay open. A
stream started with a folder for end marks reads them beside the transactions. A mark is one
row far enough ahead to close every window; its own window never closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.finance import MONEY
from ledgerlens.operators.detection import (
    MONITORED_TYPES, STRUCTURING_THRESHOLD, structuring_alerts, sweep_alerts, velocity_alerts,
)
from ledgerlens.sources.files import make_folder
from ledgerlens.streaming.bronze import start_append

SWEEP_COLUMNS = ["name_orig", "name_dest", "type", "amount", "label"]
MARK = f"step int, type string, amount {MONEY}, name_orig string, is_fraud int"
# Hours after the last step: more than a window and its watermark together.
AHEAD = 24 * 7


def mark_end(spark: SparkSession, folder: str, last_step: int, threshold: int = STRUCTURING_THRESHOLD) -> None:
    """Say that no transaction after `last_step` will come. The mark is of a monitored type and
    its amount lies just under the threshold, so that every windowed rule sees its time."""
    row = spark.range(1).select(
        F.lit(last_step + AHEAD).cast("int").alias("step"), F.lit(MONITORED_TYPES[0]).alias("type"),
        (F.lit(threshold) - F.lit("0.01").cast("decimal(3,2)")).cast(MONEY).alias("amount"),
        F.lit("").alias("name_orig"), F.lit(0).alias("is_fraud"))
    row.write.mode("append").parquet(folder)


def _with_marks(silver: DataFrame, ends: str | None) -> DataFrame:
    if ends is None:
        return silver
    spark = silver.sparkSession
    make_folder(spark, ends)
    columns = [c for c in spark.createDataFrame([], MARK).columns if c in silver.columns]
    return silver.select(*columns).unionByName(spark.readStream.schema(MARK).parquet(ends).select(*columns))


def start_sweep(
    silver: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Stateless: every transaction is judged as it arrives."""
    return start_append(sweep_alerts(silver).select(*SWEEP_COLUMNS), path, checkpoint, once)


def start_velocity(
    silver: DataFrame, path: str, checkpoint: str, once: bool = True, ends: str | None = None, **limits
) -> StreamingQuery:
    """A window is emitted once the watermark has passed its end, and never again."""
    return start_append(velocity_alerts(_with_marks(silver, ends), **limits), path, checkpoint, once)


def start_structuring(
    silver: DataFrame, path: str, checkpoint: str, once: bool = True, ends: str | None = None, **limits
) -> StreamingQuery:
    return start_append(structuring_alerts(_with_marks(silver, ends), **limits), path, checkpoint, once)
