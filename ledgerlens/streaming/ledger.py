"""Which offsets each lineage of a stream has stored, as intervals kept beside the table.

A row is the interval of one micro-batch in one source partition. It is written before the
rows are, so it never claims less than what is stored; claiming more only means that a new
lineage looks and finds nothing. A source hands out offsets in ranges, so the intervals of a
lineage's batches follow one another and merge into very few.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlens.sources.files import children, exists, write_partitions

LINEAGE, BATCH = "query_id", "batch_id"
POSITIONS = ("kafka_partition", "kafka_offset")
SCHEMA = f"kafka_partition int, first_offset bigint, last_offset bigint, {LINEAGE} string, {BATCH} bigint"
# lineage, partition, first and last offset; a None partition stands for positions unknown.
Interval = tuple[str, int | None, int | None, int | None]


def ledger_path(table: str) -> str:
    return f"{table.rstrip('/')}_offsets"


def intervals(rows: DataFrame) -> DataFrame:
    """Per source partition the first and last offset of these rows; one row for those without
    a position."""
    part, offset = POSITIONS
    return rows.groupBy(part).agg(F.min(offset).alias("first_offset"), F.max(offset).alias("last_offset"))


def record(batch: DataFrame, table: str, lineage: str, batch_id: int) -> list[Interval]:
    """Write the intervals of a batch, replacing those of an earlier attempt; returns them.

    They are one row for each source partition.
    """
    spark = batch.sparkSession
    found = [tuple(r) for r in intervals(batch).collect()]
    rows = spark.createDataFrame([(*r, lineage, batch_id) for r in found], SCHEMA)
    write_partitions(rows.coalesce(1), ledger_path(table), LINEAGE, BATCH)
    return [(lineage, *r) for r in found]


def _stored(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(ledger_path(table))


def merged(spark: SparkSession, table: str) -> DataFrame:
    """The intervals of each lineage and partition, joined where they overlap or adjoin."""
    part = Window.partitionBy(LINEAGE, "kafka_partition").orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(part.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_offset") > before + 1, F.lit(True)).cast("int")
    return (
        _stored(spark, table).withColumn("opens", opens).withColumn("run", F.sum("opens").over(part))
        .groupBy(LINEAGE, "kafka_partition", "run")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .drop("run")
    )


def others(spark: SparkSession, table: str, lineage: str, stored_in: Iterable[str]) -> list[Interval]:
    """The merged intervals of all lineages but this one. A lineage that has rows in one of
    `stored_in` but none in the ledger counts as one interval over everything."""
    known: list[Interval] = []
    if exists(spark, ledger_path(table)):
        rows = merged(spark, table).where(F.col(LINEAGE) != lineage)
        known = [tuple(r) for r in rows.select(LINEAGE, "kafka_partition", "first_offset", "last_offset").collect()]
    listed = {name.removeprefix(f"{LINEAGE}=") for path in stored_in for name in children(spark, path)
              if name.startswith(f"{LINEAGE}=")}
    return known + [(name, None, None, None) for name in sorted(listed - {k[0] for k in known} - {lineage})]


def overlapping(mine: Iterable[Interval], stored: Iterable[Interval]) -> set[str]:
    """The lineages among `stored` that may hold a position of `mine`."""
    def meets(a: Interval, b: Interval) -> bool:
        if b[1] is None and b[2] is None:
            return True
        return a[1] == b[1] and a[2] is not None and b[2] is not None and a[2] <= b[3] and b[2] <= a[3]

    return {b[0] for b in stored if any(meets(a, b) for a in mine)}


def batches(spark: SparkSession, table: str, mine: Iterable[Interval], lineages: set[str]) -> list[tuple[str, int | None]]:
    """(lineage, batch) of the stored batches of those lineages that overlap `mine`; a None batch
    stands for a lineage without a ledger."""
    found: list[tuple[str, int | None]] = []
    if exists(spark, ledger_path(table)):
        wanted = spark.createDataFrame([m[1:] for m in mine], "p int, a bigint, b bigint")
        stored = _stored(spark, table).where(F.col(LINEAGE).isin(*lineages))
        meet = (F.col("kafka_partition") == F.col("p")) & (F.col("first_offset") <= F.col("b")) & (F.col("last_offset") >= F.col("a"))
        found = [tuple(r) for r in stored.join(F.broadcast(wanted), meet, "left_semi").select(LINEAGE, BATCH).distinct().collect()]
        known = {r[0] for r in stored.select(LINEAGE).distinct().collect()}
    else:
        known = set()
    return found + [(name, None) for name in sorted(lineages - known)]
