"""What the operators share: tables in the shared folder, bounded Arrow slices, keys."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path
from ledgerlens.sources.files import remove

# Words between ASCII white space, and words of digits, a-z and anything outside ASCII.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: list[list[str]] = []


@contextmanager
def written() -> Iterator[list[str]]:
    """Collects the paths of the tables that are written meanwhile."""
    _written.append([])
    try:
        yield _written[-1]
    finally:
        _written.pop()


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that `table` wrote."""
    for path in paths:
        remove(spark, path)
    paths.clear()


def table(df: DataFrame, purpose: str) -> DataFrame:
    """Write and reread: cuts the lineage, survives lost executors, and lets two readers
    share one evaluation. The files lie in the shared folder that the session names."""
    path = scratch_path(df.sparkSession, purpose)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. `lower` does just that on ASCII-only texts, which
    are told by having as many bytes as characters, and is many times faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds at most `limit` bytes of the column, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def beside(docs: DataFrame, id_col: str, columns: str) -> str:
    """The schema of the id column as it is in docs, and the given columns."""
    kind = docs.schema[id_col].dataType.simpleString()
    return f"`{id_col}` {kind}, {columns}"


ROW = "_row_number"


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number of its own for each row; it holds once the rows are written."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())
