"""Documents to training tokens: quality, exact and near duplicates, mixing, encoding.

A stage's result is written before the next stage is called. The tables that an operator
wrote on the way to it are of no use then, and the next stage removes them first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, common, exact_dedup, mixing, near_dedup, quality
from ledgerlens.llm.queries import tokenizer_path

# The order of rows and hash-drawn copies can't be told in DuckDB SQL, nor near duplicates.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left_over: list[str] = []


def _tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.drop(spark, _left_over)
        with common.written() as paths:
            made = stage(spark, docs, sf_dir)
        _left_over.extend(paths)
        return made

    return run


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes words of it, a part of it counting as once."""
    return mixing.repeat(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe.bpe_digests(docs, tokenizer_path())


STAGES = [(name, _tidy(stage)) for name, stage in (
    ("quality", quality_rules), ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates), ("mixing", mixed), ("bpe", encoded),
)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each one's rows written and reread as the next one's.

    Empty tables, null texts and ids, repeated rows and ties are treated as each stage's
    operator says; other columns than those of documents go along to the last stage.
    """
    docs, before = common.load(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with common.written() as result:
            made = stage(spark, docs, sf_dir)
            result.clear()
            docs = common.table(made, name)
        common.drop(spark, before)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
