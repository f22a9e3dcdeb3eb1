"""Bronze: broker messages as received, parsed to a declared shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.transactions import replay_messages
from ledgerlens.sources.files import exists

# The message layout.
PAYLOAD = (
    "step int, type string, amount double, name_orig string, old_balance_orig double, "
    "new_balance_orig double, name_dest string, old_balance_dest double, "
    "new_balance_dest double, is_fraud int"
)
BRONZE = "kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, " + PAYLOAD
MESSAGE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
TOPIC = "transactions"
PARTITIONS = 6


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """The topic as a stream. Needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages landed as files, in the columns a broker source has."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def as_messages(txns: DataFrame, position: str = "kafka_offset") -> DataFrame:
    """Transactions in the broker's columns: keyed by account, one partition per key.

    The offset is the source position: unique and rising within a partition, with gaps, as
    after compaction. Numbering rows without gaps would need a window over each partition.
    """
    log = replay_messages(txns, position)
    return log.select(
        F.col("step"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("position").cast("bigint").alias("offset"),
        F.lit("2018-01-01").cast("timestamp").alias("timestamp"),
    )


def write_replay(txns: DataFrame, path: str, position: str = "kafka_offset") -> None:
    """Write the log as message files in event order, for a file-based replay.

    Ranges are cut on step and position together, so a step with a large share of all rows
    still spreads over several tasks.
    """
    messages = as_messages(txns, position)
    (
        messages.repartitionByRange("step", "offset")
        .sortWithinPartitions("step", "offset")
        .drop("step")
        .write.mode("append")
        .parquet(path)
    )


def parse(messages: DataFrame, skip_malformed: bool = False) -> DataFrame:
    """Payload fields next to the position that anchors each record in the stream.

    An unreadable payload becomes all nulls and is kept: bronze records what was delivered.
    `skip_malformed` drops those rows instead.
    """
    # The generator parses each message once. As a plain projection the parse would be
    # repeated in every later filter, once per field the filter names.
    flat = messages.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(F.from_json(F.col("value").cast("string"), PAYLOAD))),
    )
    if not skip_malformed:
        return flat
    fields = [c for c in flat.columns if not c.startswith("kafka_")]
    return flat.filter(F.coalesce(*[F.col(c).cast("string") for c in fields]).isNotNull())


def start_append(
    stream: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append a stream to a Parquet path, exactly once per checkpoint.

    The file sink logs its commits in the target. A lost checkpoint beside a surviving log
    would make it skip new data without a word, so that state is refused.
    """
    spark = stream.sparkSession
    if exists(spark, f"{path}/_spark_metadata") and not exists(spark, checkpoint):
        raise RuntimeError(
            f"{path} was written under another checkpoint than {checkpoint}: restore that "
            "checkpoint, or rebuild into a new path"
        )
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_bronze(
    messages: DataFrame, path: str, checkpoint: str, once: bool = True,
    skip_malformed: bool = False,
) -> None:
    start_append(parse(messages, skip_malformed), path, checkpoint, once).awaitTermination()
