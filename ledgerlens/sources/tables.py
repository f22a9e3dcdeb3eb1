"""Catalog tables: namespaces, slices, appends and whole-table replacement."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.functions.dates import as_date


def split_name(table: str) -> tuple[str | None, str]:
    """The namespace a qualified name starts with, and the rest: `a.b.c` is (`a`, `b.c`)."""
    head, dot, rest = table.partition(".")
    return (head, rest) if dot else (None, table)


def ensure_namespace(spark: SparkSession, table: str) -> None:
    """Create the database a table name points into, if it names one."""
    namespace, _, name = table.rpartition(".")
    if namespace and name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")


def read_slice(spark: SparkSession, table: str, column: str, on: str | date) -> DataFrame:
    """The rows of one date; on a table partitioned by it, only that partition is read."""
    return spark.read.table(table).filter(F.col(column) == as_date(on))


def append_or_create(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Append, creating the table on first use."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        # By name, so a frame with another column order cannot shift values.
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        df.write.format(fmt).partitionBy(*partition_by).saveAsTable(table)


def create_or_replace(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Make the table hold exactly these rows."""
    df.write.mode("overwrite").format(fmt).partitionBy(*partition_by).saveAsTable(table)


def replace_slice(
    df: DataFrame, table: str, column: str, value: Any, fmt: str = "parquet"
) -> None:
    """Make one partition of a catalog table hold exactly these rows, also when there are none.

    The partition is named by the caller rather than found in the rows, so an empty result
    clears what an earlier run left. Other partitions stay as they are.
    """
    spark = df.sparkSession
    exact = value if isinstance(value, Column) else F.lit(value)
    if not spark.catalog.tableExists(table):
        kind = "date" if column.endswith("_date") else "string"
        typed = df.drop(column).withColumn(column, exact.cast(kind))
        typed.write.format(fmt).partitionBy(column).saveAsTable(table)
        return
    target = spark.table(table)
    body = df.select(*[c for c in target.columns if c != column])
    view = f"replacement_{uuid.uuid4().hex}"
    body.createTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = '{value}') "
            f"SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def rows(spark: SparkSession, data: Sequence[tuple], ddl: str) -> DataFrame:
    """Literal rows with a declared schema. For fixtures, not for data."""
    return spark.createDataFrame(list(data), ddl)
