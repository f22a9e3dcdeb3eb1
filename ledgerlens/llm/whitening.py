"""Whitening of embeddings by distributed block matrices.

Centred rows are numbered and dealt into the blocks of a BlockMatrix. Its transpose times
itself is the scatter, whose eigenvectors come from a local solver: it has as many rows and
columns as a vector has entries, whatever the number of rows. A second product with the
whitening matrix projects the rows, and a third one measures how far their covariance is from
the identity. All arithmetic on rows runs in the JVM.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ROW, table

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
# Entries are stored as longs; floors beyond this bound become the bound.
FARTHEST = 9_000_000_000_000_000_000
# Rows and columns of a block. More rows make larger blocks: the driver lists their keys.
BLOCK, MOST_BLOCKS, WIDTH = 1024, 100_000, 1024
# Blocks whose products one task adds up.
BLOCKS_A_TASK = 4
# Eigenvalues below this part of the largest are rounding.
RANK = 1e-12
DECIMAL = "decimal(38,0)"


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))


def _whole_number(entry: Column) -> Column:
    scaled = F.floor(F.greatest(F.least(entry.cast("double") * SCALE, F.lit(float(FARTHEST))), F.lit(-float(FARTHEST))))
    return scaled.cast("long") + F.lit(SHIFT).cast("long")


def numbered_rows(rows: DataFrame) -> DataFrame:
    """rows with `_index` from 0 without gaps. The offsets of partitions are one row each."""
    placed = table(rows.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(ROW, 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_count"))
    # One row for each partition of the table.
    total = sizes.orderBy("_part").collect()
    starts, at = [], 0
    for r in total:
        starts.append((r["_part"], at))
        at += r["_count"]
    offsets = rows.sparkSession.createDataFrame(starts, "_part long, _start long")
    return placed.join(F.broadcast(offsets), part == offsets["_part"]).select(
        *[c for c in placed.columns if c != ROW],
        (F.col("_start") + F.col(ROW).bitwiseAND(F.lit((1 << 33) - 1))).alias("_index"))


def block_matrix(rows: DataFrame, index: str, vector: str, n: int, width: int) -> BlockMatrix:
    """The arrays of doubles in rows as a BlockMatrix of n rows."""
    vectors = rows.select(F.col(index).alias("index"), array_to_vector(vector).alias("vector"))
    height = max(BLOCK, -(-n // MOST_BLOCKS))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector")).toBlockMatrix(height, min(width, WIDTH))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix. The inner dimension is split over tasks, whose sums meet."""
    blocks = -(-matrix.numRows() // matrix.rowsPerBlock)
    product = matrix.transpose()._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, max(1, blocks // BLOCKS_A_TASK))
    out = BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
    return (out + out.T) / 2


def project(matrix: BlockMatrix, by: np.ndarray) -> DataFrame:
    """index and projected (array of double): the rows of the matrix times `by`."""
    sc, width = matrix.blocks.context, matrix.colsPerBlock
    pieces = [((i, 0), Matrices.dense(*by[at:at + width].shape, by[at:at + width].ravel("F")))
              for i, at in enumerate(range(0, len(by), width))]
    # A wrapper lets go of its JVM object when it is collected: it is held until the call is over.
    out = matrix.multiply(BlockMatrix(sc.parallelize(pieces), width, by.shape[1])).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", out._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("projected"))


def whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component (from 1, by falling eigenvalue): id, component,
    n, deviation, whitened, explained, identity_error.

    Dropped are vectors that are null or empty, have null or non-finite entries, or another
    length than most of the others have (of equally many the longest). Repeated rows and null
    ids stay and are fitted as they are; other columns are not read; an empty table, or one
    without remaining vectors, gives no row. Entries whose 64-fold is beyond 9e18 count as that.
    A deviation that no long holds is null. A component whose eigenvalue is zero or rounding
    has whitened null and is left out of identity_error, which is null where no component is
    left; explained is null where all vectors are equal.
    """
    spark = vectors.sparkSession
    out_schema = ", ".join([
        f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}", "component int, n long, deviation long",
        "whitened double, explained double, identity_error double"])
    kept = vectors.where(_finite(F.col(vector_col))).select(
        id_col, F.transform(vector_col, _whole_number).alias("_x"))
    lengths = kept.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if lengths is None:
        return spark.createDataFrame([], out_schema)
    d, n = lengths["d"], lengths["count"]
    k = min(components, d)
    rows = numbered_rows(kept.where(F.size("_x") == d))
    # d sums, which no group gathers: each task adds up its own rows first.
    sums = [F.sum(F.col("_x")[i].cast(DECIMAL)).alias(f"s{i}") for i in range(d)]
    s = [int(v) for v in rows.agg(*sums).head()]
    off = F.transform(F.arrays_zip("_x", F.array(*[F.lit(str(v)).cast(DECIMAL) for v in s]).alias("_s")),
                      lambda p: (p["_x"].cast(DECIMAL) * F.lit(n).cast("decimal(19,0)") - p["_s"]).cast(DECIMAL))
    squares = F.aggregate("_off", F.lit(0).cast(DECIMAL), lambda t, v: F.try_add(t, F.try_multiply(v, v)).cast(DECIMAL))
    centred = table(rows.withColumn("_off", off).select(
        id_col, "_index", squares.try_cast("long").alias("deviation"),
        F.transform("_off", lambda v: v.cast("double") / F.lit(float(n))).alias("_centred")), "centred")

    matrix = block_matrix(centred, "_index", "_centred", n, d)
    values, axes = np.linalg.eigh(scatter(matrix) / n)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    trace = float(values.sum())
    real = values[:k] > RANK * max(values[0], np.finfo(float).tiny)
    by = axes[:, :k] / np.sqrt(np.where(real, values[:k], 1))
    projected = table(project(matrix, by), "projected")

    error = None
    if real.any():
        means = projected.agg(*[F.avg(F.col("projected")[i]).alias(f"m{i}") for i in range(k)]).head()
        away = F.transform(F.arrays_zip("projected", F.array(*map(F.lit, means)).alias("m")), lambda p: p["projected"] - p["m"])
        own = scatter(block_matrix(projected.withColumn("_away", away), "index", "_away", n, k)) / n
        error = float(np.abs(own[np.ix_(real, real)] - np.eye(int(real.sum()))).max())
    parts = [float(v) / trace if trace > 0 else None for v in values[:k]]
    both = centred.select(id_col, "_index", "deviation").join(projected, F.col("_index") == F.col("index"))
    table_of = lambda vs, kind: F.array(*[F.lit(v).cast(kind) for v in vs])
    out = both.select(id_col, "deviation", F.posexplode("projected").alias("_at", "_w"))
    at = F.col("_at")
    return out.select(
        id_col, (at + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(table_of(map(bool, real), "boolean")[at], F.col("_w")).alias("whitened"),
        table_of(parts, "double")[at].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
