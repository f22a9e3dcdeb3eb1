"""The operators on the driver tables, with production parameters.

Each query reads its whole table and returns its operator's whole result. Nulls, empty and very
long texts, ties, repeated rows, empty tables and extra columns are treated as the docstring of
the operator it calls says; nothing is added or left out here.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import (
    bpe,
    exact_dedup,
    license_scan,
    mixing,
    near_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    token_alignment,
    token_files,
    whitening,
    wrappers,
)
from ledgerlens.llm.common import load


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(load(spark, sf_dir, "documents")).drop("spans")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(load(spark, sf_dir, "documents"), tokenizer_path())


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(load(spark, sf_dir, "documents"), tokenizer_path())


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(load(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(load(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digests(load(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(load(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digests(load(spark, sf_dir, "documents"), tokenizer_path())


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digests(load(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(load(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_token_files, op3_bpe, op4_main_text, op5_pii, op6_mixing, op7_suffix_dedup, op8_quality, op9_near_dedup, op10_exact_dedup,
        op11_packing, op12_alignment, op13_whitening)
}

ORACLES: dict[str, str] = {
    # Row numbers tell repeated (id, text) rows apart, of which one is kept.
    "op10_exact_dedup": """
with normal as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), grouped as (
  select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
    row_number() over (partition by t, doc_id) as nth
  from normal
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id and nth = 1 as kept, sha256(t) as text_sha256
from grouped""",
}
