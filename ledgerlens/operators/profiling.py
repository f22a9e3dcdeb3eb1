"""Dataset profiles over whole tables: columns, categories, fraud concentration, amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DoubleType, FloatType, MapType, StructType,
)

from ledgerlens.operators.detection import MONITORED_TYPES

# Every transaction type of the source.
TRANSACTION_TYPES = ["PAYMENT", *MONITORED_TYPES, "CASH_IN", "DEBIT"]

# Base of the exact-median search. A decimal(18,2) in cents has three such digits, and each
# takes about a million values, which bounds every intermediate result per group.
_BASE = 1_000_000


def _cell(df: DataFrame, name: str) -> Column:
    """A value as text, such that two cells are equal exactly where their values are."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, (FloatType, DoubleType)):
        return (value + F.lit(0.0)).cast("string")  # one zero, not two
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    if isinstance(kind, BinaryType):
        return F.hex(value)
    return value.cast("string")


def profile_columns(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Per column its type, share of non-null values and number of distinct values.

    One pass over the whole table. Exact distinct counts take the table apart into
    (column, value) cells and count equal cells before and after one shuffle; an aggregate
    with a distinct count per column would shuffle rows as wide as the table for each of
    them. `exact=False` counts with HyperLogLog++ and shuffles one row per task: the choice
    for wide tables at the largest scale.
    """
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    if exact:
        cells = F.array(*[
            F.struct(F.lit(i).alias("i"), _cell(df, c).alias("v")) for i, c in enumerate(names)
        ])
        counted = (
            df.select(F.inline(cells))
            .groupBy("i", "v")
            .agg(F.count("*").alias("n"))
            .groupBy("i")
            .agg(
                F.sum("n").alias("rows"),
                F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("filled"),
                F.count("v").alias("distinct_count"),
            )
        )
    else:
        one_row = df.agg(
            F.count("*").alias("rows"),
            *[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(names)],
            *[F.approx_count_distinct(F.col(c)).alias(f"d_{i}") for i, c in enumerate(names)],
        )
        counted = one_row.select(F.inline(F.array(*[
            F.struct(
                F.lit(i).alias("i"), F.col("rows"), F.col(f"n_{i}").alias("filled"),
                F.col(f"d_{i}").alias("distinct_count"),
            )
            for i in range(len(names))
        ])))
    return counted.select(
        F.array(*[F.lit(c) for c in names])[F.col("i")].alias("column_name"),
        F.array(*[F.lit(kinds[c]) for c in names])[F.col("i")].alias("data_type"),
        F.coalesce(
            F.try_divide(F.col("filled").cast("double") * 100, F.col("rows")), F.lit(0.0)
        ).alias("non_null_pct"),
        "distinct_count",
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column its share of nulls: one pass and no shuffle beyond one row per task."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(names)],
    )
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(
                F.try_divide(
                    (F.col("rows") - F.col(f"n_{i}")).cast("double") * 100, F.col("rows")
                ),
                F.lit(0.0),
            ).alias("null_pct"),
        )
        for i, c in enumerate(names)
    ])))


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of every value of several columns, in one pass over the table.

    Nulls are not a category, but they count in the total a share is taken of. That total is
    a scalar subquery that reads no column; a window over the column would bring every
    distinct value of it into one task.
    """
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ]
    total = df.select(F.count("*")).scalar()
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("row_count"))
        .withColumn("share_pct", F.col("row_count").cast("double") * 100 / total)
    )


def rows_per_year(df: DataFrame, text_date: str = "issue_d") -> DataFrame:
    """Rows per year of a `Mon-yyyy` text column: its last four characters."""
    return (
        df.filter(F.col(text_date).isNotNull())
        .groupBy(F.right(F.col(text_date), F.lit(4)).alias("year"))
        .agg(F.count("*").alias("row_count"))
    )


def fraud_by_type(
    txns: DataFrame, types: Sequence[str] = tuple(TRANSACTION_TYPES)
) -> DataFrame:
    """Count, fraud, fraud share and mean amount per type; a type without rows shows zeros."""
    wanted = txns.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(t) for t in types])).alias("type")
    )
    seen = txns.filter(F.col("type").isin(*types)).groupBy("type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("is_fraud") == 1).alias("frauds"),
        F.sum("amount").alias("total"),
    )
    n, frauds = F.coalesce("n", F.lit(0)), F.coalesce("frauds", F.lit(0))
    return wanted.join(seen, "type", "left").select(
        "type",
        n.alias("row_count"),
        frauds.alias("fraud_count"),
        F.coalesce(F.try_divide(frauds.cast("double") * 100, n), F.lit(0.0)).alias("fraud_pct"),
        F.coalesce(F.try_divide(F.col("total").cast("double"), n), F.lit(0.0)).alias(
            "avg_amount"
        ),
    )


def exact_median(df: DataFrame, group: str, value: str, scale: int = 2) -> DataFrame:
    """The exact median of a decimal(18, scale) column per non-null group: `group, median`.

    `percentile` would gather a group's values in one task. Here equal values collapse into
    counts, and the middle ranks are located digit by digit: each of three rounds counts at
    most a million digit values per group and keeps the one that holds the rank, so no task
    ever sees more than that.
    """
    cents = (F.col(value).cast(f"decimal(18,{scale})") * F.lit(10**scale)).cast("bigint")
    counts = (
        df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
        .groupBy(F.col(group).alias("g"), F.coalesce(cents, F.lit(0)).alias("v"))
        .agg(F.count("*").alias("n"))
    )
    # Floor division, so that negative numbers order rightly by their digits. The digits are
    # declared non-null: a not-null filter that only some rounds infer would make their
    # inputs differ, and the counts would be computed anew for each round.
    digits = (
        counts.withColumn("d2", F.expr(f"coalesce(pmod(v, {_BASE}), 0)"))
        .withColumn("v1", F.expr(f"coalesce((v - d2) div {_BASE}, 0)"))
        .withColumn("d1", F.expr(f"coalesce(pmod(v1, {_BASE}), 0)"))
        .withColumn("d0", F.expr(f"coalesce((v1 - d1) div {_BASE}, 0)"))
        .select("g", "d0", "d1", "d2", "n")
    )
    # The lower and upper middle rank of each group, equal for an odd number of rows.
    wanted = (
        counts.groupBy("g")
        .agg(F.sum("n").alias("size"))
        .select(
            "g",
            F.explode(F.expr("array_distinct(array((size + 1) div 2, (size + 2) div 2))"))
            .alias("target"),
        )
        .withColumn("rank", F.col("target"))
    )
    fixed: list[str] = []
    for digit in ("d0", "d1", "d2"):
        histogram = digits.groupBy("g", *fixed, digit).agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("g", "target").orderBy(digit))
        before = F.col("upto") - F.col("n")
        wanted = (
            wanted.join(histogram, ["g", *fixed])
            .withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("rank")) & (before < F.col("rank")))
            .select("g", "target", (F.col("rank") - before).alias("rank"), *fixed, digit)
        )
        fixed.append(digit)

    whole = (F.col("d0") * F.lit(_BASE) + F.col("d1")) * F.lit(_BASE) + F.col("d2")
    return wanted.groupBy(F.col("g").alias(group)).agg(
        F.avg(whole.cast("double") / F.lit(float(10**scale))).alias("median")
    )


def amount_stats(txns: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Median, mean and maximum amount per label, over every row."""
    simple = txns.groupBy(label).agg(
        F.count("*").alias("row_count"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("mean_amount"),
        F.max("amount").alias("max_amount"),
    )
    # The null label is one too, and a label without any amount has no median.
    key = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))
    medians = exact_median(txns.withColumn("label_key", key), "label_key", "amount").withColumnRenamed(
        "median", "median_amount"
    )
    return simple.withColumn("label_key", key).join(medians, "label_key", "left").select(
        label, "row_count", "median_amount", "mean_amount", "max_amount"
    )


def drain_signature(txns: DataFrame) -> DataFrame:
    """How often an account is emptied, among fraud and among the rest: one row."""
    drained = (F.col("new_balance_orig") == 0) & (F.col("old_balance_orig") > 0)
    fraud = F.col("is_fraud") == 1
    return txns.agg(
        F.count_if(fraud).alias("fraud_count"),
        F.count_if(drained & fraud).alias("drained_fraud"),
        F.count_if(drained & ~fraud).alias("drained_legit"),
        (
            F.count_if(drained & fraud).cast("double") * 100
            / F.greatest(F.count_if(fraud), F.lit(1))
        ).alias("drained_fraud_pct"),
    )


def step_span(txns: DataFrame) -> DataFrame:
    """First and last hourly step and the days between them."""
    first, last = F.min("step"), F.max("step")
    return txns.agg(
        first.alias("first_step"), last.alias("last_step"),
        ((last - first + 1).cast("double") / 24).alias("span_days"),
    )
