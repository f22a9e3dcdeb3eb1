"""Path-based datasets: partition reads, idempotent partition writes, compaction, inventory."""

from __future__ import annotations

import csv
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.functions.dates import as_date

TARGET_FILE_BYTES = 128 * 1024 * 1024
# Files a task holds open while it writes partitions; rows of further ones are sorted.
OPEN_FILES = 8


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a path this package wrote; false where there was none."""
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder, which may exist already."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries right under a path; one listing, nothing below it."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(target)]


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV path by their header. Each file is opened for its first line."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found: dict[tuple[str, ...], list[str]] = {}
    for name in spark.read.text(path).inputFiles():
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            source = codec.createInputStream(stream) if codec else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
        finally:
            stream.close()
        if line is not None:
            header = tuple(next(csv.reader([line.removeprefix("\ufeff")]), []))
            found.setdefault(header, []).append(name)
    return found


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with declared types, so an id never becomes a number in some files only.

    Extracts come with their columns in one order this year and in another the next. Files are
    grouped by header, each group is matched to the schema by name, only the declared columns
    are parsed, and the groups are united. A declared column that a header lacks is refused.
    """
    names = {f.name for f in schema.fields}
    united = None
    for header, found in _headers(spark, path).items():
        if absent := sorted(names - set(header)):
            raise ValueError(f"{found[0]} lacks the declared columns {', '.join(absent)}")
        full = StructType()
        for name in header:
            full = full.add(schema[name] if name in names else StructField(name, StringType()))
        part = (
            spark.read.schema(full).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").csv(found)
            .select(*[f.name for f in schema.fields])
        )
        united = part if united is None else united.unionByName(part)
    return spark.createDataFrame([], schema) if united is None else united


def read_partition(
    spark: SparkSession, root: str, on: str | date, column: str = "snapshot_date"
) -> DataFrame:
    """One partition, read through the root so the partition column is kept and pruned on."""
    return spark.read.parquet(root).filter(F.col(column) == as_date(on))


@contextmanager
def _streaming_writers(spark: SparkSession) -> Iterator[None]:
    """A task writes the rows of up to OPEN_FILES partitions as they come. By default it sorts
    all its rows by partition first, which holds them in memory."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_partitions(
    df: DataFrame, root: str, *columns: str, rebalance: bool = False
) -> None:
    """Replace the partitions the rows belong to and leave all others alone.

    Files are staged and swapped in at job commit, so a job that fails midway changes
    nothing and a rerun converges. Every task writes one file per partition it holds rows
    of; `rebalance` first gathers rows by partition, splitting large ones and merging small
    ones, which pays where tasks times partitions would be too many files.
    """
    if rebalance:
        df = df.hint("rebalance", *columns)
    with _streaming_writers(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .parquet(root)
        )


def replace_partition(
    df: DataFrame, root: str, column: str, value: Any, *, known_empty: bool | None = None
) -> None:
    """Make one partition hold exactly these rows, also when there are none.

    A dynamic overwrite leaves a partition without new rows as it was; here the caller names
    the partition, and an empty result clears it. Pass `known_empty` where the row count is
    already known, to save the look.
    """
    spark = df.sparkSession
    empty = df.isEmpty() if known_empty is None else known_empty
    if empty:
        remove(spark, f"{root.rstrip('/')}/{column}={value}")
        return
    kind = "date" if column.endswith("_date") else None
    exact = F.lit(value).cast(kind) if kind else F.lit(value)
    write_partitions(df.drop(column).withColumn(column, exact), root, column)


def file_inventory(
    spark: SparkSession, root: str, partition_pattern: str = r"([^/]+=[^/]+)/",
) -> DataFrame:
    """One row per data file: path, bytes, modification time, partition and version.

    Only file listings are read: the content column is pruned away.
    """
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(
            "path",
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified_at"),
            F.regexp_extract(path, partition_pattern, 1).alias("partition"),
            F.regexp_extract(path, r"version=(\d+)/", 1).try_cast("bigint").alias("version"),
        )
    )


def compact(
    spark: SparkSession, root: str, out: str, columns: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite a dataset into files near a target size, at `out`.

    Returns files and bytes before and after. The original is not touched: a table is
    switched to the compacted path once it is complete. Within a partition the rows are
    spread over as many tasks as it needs files, so a partition with most of the data is
    not funnelled through one task.
    """
    sizes = file_inventory(spark, root).groupBy("partition").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
    writers_of = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")
    before = sizes.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(writers_of), F.lit(1)).alias("writers"),
    ).first()
    data = spark.read.parquet(root)
    if columns:
        # ceil(bytes / target) writers per partition, joined on by its path segment.
        writers = sizes.select(
            F.col("partition").alias("_segment"),
            writers_of.alias("_files"),
        )
        first = columns[0]
        segment = F.concat(F.lit(f"{first}="), F.col(first).cast("string"))
        spread = (
            data.withColumn("_segment", segment)
            # One row per partition, which the driver has listed already.
            .join(F.broadcast(writers), "_segment", "left")
            # Dealt out in turn: equal rows do not end up with one writer.
            .withColumn(
                "_writer",
                F.pmod(
                    F.monotonically_increasing_id(),
                    F.greatest(F.coalesce("_files", F.lit(1)), F.lit(1)),
                ),
            )
            .drop("_segment", "_files")
            .repartition(before["writers"], *columns, "_writer")
            .drop("_writer")
        )
        with _streaming_writers(spark):
            spread.write.partitionBy(*columns).parquet(out)
    else:
        wanted = max(1, math.ceil(before["bytes"] / target_bytes))
        data.repartition(wanted).write.parquet(out)
    after = file_inventory(spark, out).agg(
        F.count("*").alias("files_after"), F.sum("bytes").alias("bytes_after")
    )
    return after.select(
        F.lit(before["files"]).alias("files_before"),
        F.lit(before["bytes"]).alias("bytes_before"),
        "files_after", "bytes_after",
    )
