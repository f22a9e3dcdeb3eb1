"""Silver transactions and the checks on their stream positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.finance import MONEY

POSITION = ["kafka_partition", "kafka_offset"]

# Silver column and type; None keeps the landed type.
LAYOUT = [
    ("step", "int"),
    ("type", None),
    ("amount", MONEY),
    ("name_orig", None),
    ("old_balance_orig", MONEY),
    ("new_balance_orig", MONEY),
    ("name_dest", None),
    ("old_balance_dest", MONEY),
    ("new_balance_dest", MONEY),
    ("is_fraud", "int"),
    ("kafka_offset", "long"),
]


def conform(df: DataFrame, *carry: str) -> DataFrame:
    """Landed transactions to silver types; a value that does not fit becomes null.

    An offset is unique only within its partition, so the partition goes along where the
    source has one. `carry` names columns that go along as they are.
    """
    columns = [
        (F.col(name).try_cast(kind) if kind else F.col(name)).alias(name)
        for name, kind in LAYOUT
    ]
    if "kafka_partition" in df.columns:
        columns.append(F.col("kafka_partition").try_cast("int").alias("kafka_partition"))
    return df.select(*columns, *carry)


def stream_positions(df: DataFrame) -> DataFrame:
    """One row `row_count, position_count`; they differ when a stream was replayed."""
    return (
        df.groupBy(*POSITION)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count("*").alias("position_count"),
        )
    )


def dedupe_stream(df: DataFrame) -> DataFrame:
    """One row per stream position. Copies collapse before the shuffle."""
    return df.dropDuplicates(POSITION)


def replay_order(df: DataFrame, position: str = "kafka_offset") -> DataFrame:
    """Transactions in event order, equal steps in source order.

    The sort key includes the position, so the range partitions of the sort split inside a
    step that holds a large share of all rows.
    """
    return df.orderBy("step", position)


def replay_messages(
    df: DataFrame, position: str = "kafka_offset", limit: int | None = None
) -> DataFrame:
    """The log as messages keyed by account: `step, position, key, value`.

    `limit` takes the head of the log, as a replay of its first messages does. Sorting is
    the caller's (`replay_order`, a range-partitioned write) unless a limit asks for it here.
    """
    payload = F.to_json(
        F.struct(
            F.col("step").cast("int").alias("step"),
            F.col("type"),
            *[
                F.col(c).cast("double").alias(c) if c not in ("name_orig", "name_dest")
                else F.col(c)
                for c in (
                    "amount", "name_orig", "old_balance_orig", "new_balance_orig", "name_dest",
                    "old_balance_dest", "new_balance_dest",
                )
            ],
            F.col("is_fraud").cast("int").alias("is_fraud"),
        )
    )
    log = df if limit is None else replay_order(df, position).limit(limit)
    return log.select(
        "step",
        F.col(position).alias("position"),
        F.col("name_orig").alias("key"),
        payload.alias("value"),
    )
