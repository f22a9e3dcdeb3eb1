"""Silver: the contract applied to each micro-batch, with replay-safe writes.

Each batch goes to the partition (query id, batch id). The query id lives in the
checkpoint, so a retried batch overwrites itself, and a stream restarted on a lost
checkpoint writes elsewhere. Such a new lineage leaves out the messages an older one has
already stored in either table, so a full replay adds nothing twice. A message is told by its
position, timestamp and content: another one at a stored position stops the run, as offsets
start again when a topic is recreated.

A batch is evaluated once, into a staging table split by outcome. A ledger of offset intervals
tells which stored batches can hold its positions; where none can, no stored row is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlens.contracts import Contract
from ledgerlens.contracts.contract import FAILED
from ledgerlens.operators.transactions import POSITION, conform
from ledgerlens.session import scratch_path
from ledgerlens.sources.files import exists, remove, write_partitions
from ledgerlens.streaming import ledger
from ledgerlens.streaming.ledger import BATCH, LINEAGE

CONTRACT = "txn_monitoring_transaction"
STAMP = "kafka_timestamp"


def bronze_stream(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A landed table as a stream of its new files.

    Declare the schema where columns were added over time: older rows then read as null
    there. Bronze is written exactly once; a silver batch that is retried replaces its files,
    so a stream over silver belongs after the silver run, not beside it.
    """
    if schema is None:
        schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def _stored_rows(like: DataFrame, paths: tuple[str, str], batches: list[tuple[str, int | None]]) -> DataFrame | None:
    """Position, `_stamp` and `_content` of what these batches have stored in the tables. A
    timestamp that was not stored is null."""
    spark, found = like.sparkSession, None
    for path in paths:
        folders = [f"{path}/{LINEAGE}={name}" + ("" if batch is None else f"/{BATCH}={batch}") for name, batch in batches]
        folders = [f for f in folders if exists(spark, f)]
        if folders:
            # The schema is declared, as a lineage may hold no row of this table.
            rows = _told(spark.read.schema(like.schema).option("basePath", path).parquet(*folders).select(*like.columns))
            rows = rows.select(*POSITION, "_stamp", "_content")
            found = rows if found is None else found.unionByName(rows)
    return found


def _told(df: DataFrame) -> DataFrame:
    """Next to each row what tells its message from another at the same position."""
    content = [c for c in df.columns if c not in (*POSITION, STAMP, FAILED)]
    stamp = F.col(STAMP) if STAMP in df.columns else F.lit(None).cast("timestamp")
    return df.withColumns({"_stamp": stamp, "_content": F.struct(*content)})


class _Staged:
    """Tagged rows of a batch, stored once by outcome."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.schema = spark, scratch_path(spark, "batch"), None

    def write(self, tagged: DataFrame) -> None:
        rows = tagged.withColumn("_broken", F.size(FAILED) > 0)
        rows.write.partitionBy("_broken").parquet(self.path)
        self.schema = rows.schema

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def outcome(self, broken: bool) -> DataFrame:
        found = self.rows.where(F.col("_broken") == F.lit(broken)).drop("_broken")
        return found if broken else found.drop(FAILED)

    def drop(self) -> None:
        remove(self.spark, self.path)


def _fresh(staged: _Staged, stored: DataFrame) -> _Staged:
    """Staged again without stored messages; raises where a stored position holds another one.

    One join on the position tells both, and the rows that clash are observed as the others
    are written. Rows without a position meet nothing and stay.
    """
    rows = _told(staged.rows.drop("_broken")).alias("a")
    b = stored.withColumn("_seen", F.lit(True)).alias("b")
    at = (F.col("a.kafka_partition") == F.col("b.kafka_partition")) & (
        F.col("a.kafka_offset") == F.col("b.kafka_offset"))
    same = F.col("a._content").eqNullSafe(F.col("b._content")) & F.coalesce(
        F.col("a._stamp") == F.col("b._stamp"), F.lit(True))
    clash = F.col("b._seen").isNotNull() & ~same
    clashes = Observation("clashes")
    joined = rows.join(b, at, "left").observe(
        clashes, F.count_if(clash).alias("n"), F.min(F.when(clash, F.struct("a.kafka_partition", "a.kafka_offset"))).alias("first"))
    kept = _Staged(staged.spark)
    try:
        kept.write(joined.where(F.col("b._seen").isNull()).select("a.*").drop("_stamp", "_content"))
        if clashes.get["n"]:
            part, offset = clashes.get["first"]
            raise RuntimeError(
                f"partition {part} offset {offset} is stored with other content: if the topic "
                "was recreated, write it into new tables"
            )
    except BaseException:
        kept.drop()
        raise
    return kept


def batch_writer(
    contract: Contract, silver: str, quarantine: str, dedupe: bool = False
) -> Callable[[DataFrame, int], None]:
    """The handler of one micro-batch.

    A broker delivers a position once per batch, so rows are not compared with each other;
    `dedupe` does, for a source that may hold copies, at the price of a shuffle. Only rows
    equal in every column are copies.
    """
    older: dict[str, list[ledger.Interval]] = {}

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lineage = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "unnamed"
        stamped = [STAMP] if STAMP in batch.columns else []
        landed = conform(batch, *stamped)
        if dedupe:
            # Rows without a position cannot be told apart by it and are all kept.
            placed = F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull()
            landed = landed.filter(placed).dropDuplicates().unionByName(landed.filter(~placed))
        if lineage not in older:
            # What other lineages have stored does not change while this one runs.
            older[lineage] = ledger.others(spark, silver, lineage, (silver, quarantine))
        staged = _Staged(spark)
        try:
            staged.write(contract.tag(landed, carry=["kafka_partition", *stamped]))
            mine = ledger.record(staged.rows, silver, lineage, batch_id)
            if met := ledger.overlapping(mine, older[lineage]):
                like = staged.outcome(True)
                stored = _stored_rows(like, (silver, quarantine), ledger.batches(spark, silver, mine, met))
                if stored is not None:
                    first, staged = staged, _fresh(staged, stored)
                    first.drop()
            for broken, path in ((False, silver), (True, quarantine)):
                write_partitions(
                    staged.outcome(broken).withColumn(LINEAGE, F.lit(lineage)).withColumn(BATCH, F.lit(batch_id)),
                    path, LINEAGE, BATCH,
                )
        finally:
            staged.drop()

    return handle


def start_silver(
    bronze: DataFrame, silver: str, quarantine: str, checkpoint: str, once: bool = True,
    dedupe: bool = False,
) -> StreamingQuery:
    handle = batch_writer(Contract.named(CONTRACT), silver, quarantine, dedupe)
    writer = bronze.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_silver(
    bronze: DataFrame, silver: str, quarantine: str, checkpoint: str, once: bool = True,
    dedupe: bool = False,
) -> None:
    start_silver(bronze, silver, quarantine, checkpoint, once, dedupe).awaitTermination()


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows without the columns that organise the storage."""
    return spark.read.parquet(path).drop(LINEAGE, BATCH)
