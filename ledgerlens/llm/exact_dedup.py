"""Exact deduplication by a tree-merge of sorted digest runs.

Each row becomes a digest row and is dealt to one of some number of runs, a power of two. A run
is sorted by digest and holds each digest once, with the largest identifier and the number of
its rows. In round r the runs whose numbers differ in bit r are merged: each of the two is cut by
digest, the parts that belong together meet in one task, are sorted and merged there, and the
larger identifier is retained. After as many rounds as the run numbers have bits one run is
left. What it says of the digests that several rows have travels back down the same tree.

A digest that a third of all rows share is one row of each run, so no task of a round holds more
of it than two; on the way down its rows are spread over all runs, of which there are a fourth as
many as shuffle partitions. Every level is a written table: a lost executor costs no earlier round.

A digest is verified by the byte length and a second, independent hash of the same text that
travel with it: rows are merged only where all three agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import ROW, ascii_lower, numbered, table, whole

DIGEST = ["_digest", "_bytes", "_check"]


def run_count(spark: SparkSession) -> int:
    """The power of two that is at least a fourth of the shuffle partitions."""
    wanted = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    return 1 << (wanted - 1).bit_length()


def digests(docs: DataFrame, runs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and a number of its own for each row, SHA-256 of the text with A-Z lower-cased (null:
    empty), its checks, and its run. Numbers and runs hold once the rows are written."""
    normal = numbered(docs.select(F.col(id_col).alias("_id"), ascii_lower(whole(text_col)).alias("_normal")))
    return normal.select(
        ROW, "_id",
        F.unhex(F.sha2("_normal", 256)).alias("_digest"),
        F.octet_length("_normal").alias("_bytes"),
        F.xxhash64("_normal").alias("_check"),
        F.pmod(F.xxhash64(ROW), F.lit(runs)).cast("int").alias("_run"),
    )


def merge_up(rows: DataFrame, runs: int) -> list[DataFrame]:
    """The levels of the tree: the sorted runs, and what each round makes of them, one run last.

    An identifier is a struct, which Spark aggregates by sorting: rows that are equal lie side
    by side, before they are sent and again where they meet.
    """
    levels = [table(rows.groupBy("_run", *DIGEST).agg(
        F.max(F.struct("_id", ROW)).alias("_keep"), F.count(F.lit(1)).alias("_size")), "runs")]
    while runs > 1:
        runs //= 2
        merged = levels[-1].withColumn("_run", F.shiftright("_run", 1)).groupBy("_run", *DIGEST).agg(
            F.max("_keep").alias("_keep"), F.sum("_size").alias("_size"))
        levels.append(table(merged, "runs"))
    return levels


def groups(rows: DataFrame, runs: int) -> DataFrame:
    """Digest rows with the identifier that stays and the size of their group."""
    *lower, top = merge_up(rows, runs)
    known = top.filter("_size > 1")
    for level in reversed(lower):
        parents = known.withColumnRenamed("_run", "_parent")
        own = level.select("_run", *DIGEST, F.shiftright("_run", 1).alias("_parent"))
        known = own.join(parents, [*DIGEST, "_parent"]).drop("_parent")
    return rows.join(known, ["_run", *DIGEST], "left").withColumns({
        "_keep": F.coalesce("_keep", F.struct("_id", ROW)), "_size": F.coalesce("_size", F.lit(1).cast("long"))})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with
    the largest id stays; of rows repeated with that id exactly one is kept. Null ids lose
    against any other; a group of null ids keeps one of them. Other columns are not read. An
    empty table gives an empty result.
    """
    runs = run_count(docs.sparkSession)
    rows = table(digests(docs, runs, id_col, text_col), "digests")
    return groups(rows, runs).select(
        F.col("_id").alias(id_col),
        F.col("_keep._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col(ROW) == F.col(f"_keep.{ROW}")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one per text, with the columns of docs, whatever they are
    called. Nulls, ties, repeated rows and empty tables are treated as `exact_dedup` says."""
    stored = table(numbered(docs), "copies")
    at = stored.select(F.struct(F.col(id_col).alias("id"), F.col(ROW).alias("row")).alias("_at"), F.col(text_col).alias("_text"))
    kept = exact_dedup(at, "_at", "_text").filter("kept").select(F.col("_at.row").alias(ROW))
    return stored.join(kept, ROW, "left_semi").select(*docs.columns)
