"""Natural keys, pseudonyms and content fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def is_natural_key(key: Column) -> Column:
    """True for a string of digits and nothing else; false, not null, for a missing key."""
    return F.coalesce(key.rlike(r"\A[0-9]+\z"), F.lit(False))


def pseudonym(key: Column) -> Column:
    """A stable party key that does not carry the source id."""
    return F.substring(F.sha2(F.concat(F.lit("lc-"), key), 256), 1, 16)


def exposure_key(key: Column) -> Column:
    return F.concat(F.lit("LC-"), key)


def fingerprint(columns: Iterable[str]) -> list[Column]:
    """Aggregates that tell two row multisets apart whatever their order and file layout.

    A sum and an xor of one 64-bit row hash, next to the count. Columns are hashed in name
    order, so column order does not matter either. The hash skips nulls, so a flag for each
    column is hashed too.
    """
    ordered = sorted(columns)
    row = F.xxhash64(*ordered, *[F.col(c).isNull() for c in ordered])
    return [
        F.count("*").alias("row_count"),
        F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row).alias("hash_xor"),
    ]
