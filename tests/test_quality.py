"""Drift, profiles, investigation, history."""

import random
import statistics
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import txns
from ledgerlens.operators import drift, history, profiling, reports, transactions


def period(spark, *amounts):
    return spark.createDataFrame(
        [(f"LC-{i}", D(str(a))) for i, a in enumerate(amounts)],
        "exposure_id string, outstanding_amount decimal(18,2)",
    )


def measures():
    return {"exposure_count": F.count("*"), "total": F.sum("outstanding_amount")}


def test_measure(spark):
    assert drift.measure(period(spark, 100, 200, 300), measures()) == {
        "exposure_count": 3.0, "total": 600.0
    }
    assert drift.measure(period(spark, 1).filter("false"), measures()) == {
        "exposure_count": 0.0, "total": 0.0
    }


@pytest.mark.parametrize("before, after, kind", [
    (1000.0, 1100.0, None), (1000.0, 100_000.0, "drift"), (1000.0, 500.0, "drift"),
    (1000.0, 1000.0, "unchanged"), (0.0, 1000.0, "drift"), (0.0, 0.0, "unchanged"),
    (1000.0, 1250.0, None), (1000.0, 750.0, None), (1000.0, 0.0, "drift"),
])
def test_moves_are_judged_by_size(spark, before, after, kind):
    measured = spark.createDataFrame(
        [(1, "m", before), (2, "m", after)], "period int, measure string, value double"
    )
    assert drift.period_drift(measured).first()["kind"] == kind
    breaches = drift.period_breaches(measured).collect()
    assert [b["kind"] for b in breaches] == ([kind] if kind else [])
    if kind == "drift":
        assert f"{before:,.2f} -> {after:,.2f}" in breaches[0]["text"]


def test_a_measure_without_a_previous_value_is_not_judged(spark):
    measured = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 1.0), (2, "a", 1.05), (2, "b", 9.0), (2, "new", 4.0)],
        "period int, measure string, value double",
    )
    breaches = drift.period_breaches(measured).collect()
    assert [b["measure"] for b in breaches] == ["b"] and "9.00x" in breaches[0]["text"]


def test_period_measures_over_several_periods(spark):
    df = period(spark, 10, 20, 30).withColumn("p", F.lit(1)).unionByName(
        period(spark, 10).withColumn("p", F.lit(2))
    )
    rows = {(r["period"], r["measure"]): r["value"]
            for r in drift.period_measures(df, "p", measures()).collect()}
    assert rows == {(1, "exposure_count"): 3.0, (1, "total"): 60.0,
                    (2, "exposure_count"): 1.0, (2, "total"): 10.0}


def test_profile_counts_values_not_their_text(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "a", [1], b"x"), (1, -0.0, None, [1], b"x"), (2, float("nan"), "b", None, None),
         (None, float("nan"), "", [1, 2], b"y")],
        "i int, d double, s string, l array<int>, b binary",
    )
    rows = {r["column_name"]: r for r in profiling.profile_columns(df).collect()}
    assert {c: r["distinct_count"] for c, r in rows.items()} == {
        "i": 2, "d": 2, "s": 3, "l": 2, "b": 2
    }
    assert rows["s"]["non_null_pct"] == 75.0 and rows["l"]["data_type"] == "array<int>"
    near = {r["column_name"]: r["distinct_count"]
            for r in profiling.profile_columns(df, ["i", "s"], exact=False).collect()}
    assert near == {"i": 2, "s": 3}


def test_null_rates_and_categories(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert profiling.null_rates(df).first()["null_pct"] == 25.0
    shares = {r["value"]: (r["row_count"], r["share_pct"])
              for r in profiling.category_frequencies(df, ["c"]).collect()}
    assert shares == {"a": (2, 50.0), "b": (1, 25.0)}


@pytest.mark.parametrize("seed, n", [(1, 1), (2, 2), (3, 501), (4, 500)])
def test_exact_median(spark, seed, n):
    rng = random.Random(seed)
    values = [(rng.choice("xy"), D(rng.randrange(-10**6, 10 ** rng.randrange(1, 17))) / 100)
              for _ in range(n)]
    # A third of all rows share one value.
    values += [("x", D("74.00"))] * (n // 2)
    df = spark.createDataFrame(values, "g string, v decimal(18,2)")
    got = {r["g"]: r["median"] for r in profiling.exact_median(df, "g", "v").collect()}
    for g in got:
        want = statistics.median([v for k, v in values if k == g])
        assert got[g] == pytest.approx(float(want), rel=1e-12)
    assert set(got) == {k for k, _ in values}


def test_transaction_facts(spark):
    df = txns(
        spark,
        {"step": 1, "amount": 10, "old_balance_orig": 10, "new_balance_orig": 0, "is_fraud": 1},
        {"step": 48, "amount": 30, "type": "PAYMENT"},
    )
    kinds = {r["type"]: r for r in profiling.fraud_by_type(df).collect()}
    assert set(kinds) == set(profiling.TRANSACTION_TYPES)
    assert kinds["TRANSFER"]["fraud_pct"] == 100.0 and kinds["DEBIT"]["row_count"] == 0
    assert kinds["DEBIT"]["avg_amount"] == 0.0 and kinds["PAYMENT"]["avg_amount"] == 30.0
    assert profiling.step_span(df).first()["span_days"] == 2.0
    drained = profiling.drain_signature(df).first()
    assert (drained["drained_fraud"], drained["drained_legit"]) == (1, 0)
    stats = {r["is_fraud"]: r["median_amount"] for r in profiling.amount_stats(df).collect()}
    assert stats == {0: 30.0, 1: 10.0}


def test_rows_per_year(spark):
    df = spark.createDataFrame([("Dec-2018",), ("Jan-2018",), ("Jan-2017",), (None,)], "issue_d string")
    assert {r["year"]: r["row_count"] for r in profiling.rows_per_year(df).collect()} == {
        "2018": 2, "2017": 1
    }


def test_positions_and_dedupe_after_a_replay(spark):
    once = spark.range(100).selectExpr("cast(id % 6 as int) as kafka_partition", "id as kafka_offset")
    twice = once.union(once)
    row = transactions.stream_positions(twice).first()
    assert (row["row_count"], row["position_count"]) == (200, 100)
    assert transactions.dedupe_stream(twice).count() == 100
    # An offset alone is not a position.
    split = once.withColumn("kafka_offset", F.col("kafka_offset") % 2)
    assert transactions.stream_positions(split).first()["position_count"] == 6


def test_quarantine_views_and_duplicates(spark):
    q = spark.createDataFrame([(["a"],), (["a"],), (["a", "b"],)], "failed_rules array<string>")
    assert [(r["rule"], r["row_count"]) for r in reports.quarantine_by_rule(q).collect()] == [
        ("a", 3), ("b", 1)
    ]
    assert [r["row_count"] for r in reports.quarantine_by_combination(q).collect()] == [2, 1]
    assert [(r["broken"], r["row_count"]) for r in reports.quarantine_by_size(q).collect()] == [
        (2, 1), (1, 2)
    ]
    df = spark.createDataFrame([("x", 1), ("x", 1), ("y", 1)], "k string, d int")
    assert reports.duplicate_grain(df, ["k", "d"]).first()["copies"] == 2


def test_arrival_gaps_show_the_absent_day(spark):
    df = spark.sql("select date'2018-12-01' as snapshot_date union all select date'2018-12-03'")
    rows = reports.arrival_gaps(df, "snapshot_date", "2018-12-01", "2018-12-03").orderBy("snapshot_date")
    assert [r["row_count"] for r in rows.collect()] == [1, 0, 1]


def test_as_of_reads_each_partition_at_its_own_version(spark):
    df = spark.createDataFrame(
        [("p", 1, "old"), ("p", 3, "new"), ("q", 2, "only")], "part string, version int, v string"
    )
    def at(v):
        return {r["v"] for r in history.read_as_of(df, ["part"], v).collect()}

    assert (at(0), at(1), at(2), at(3)) == (set(), {"old"}, {"old", "only"}, {"new", "only"})


def test_storage_and_retention(spark):
    files = spark.createDataFrame(
        [("p", 1, 100), ("p", 2, 40), ("p", 2, 60), ("q", 1, 10)],
        "part string, version int, bytes bigint",
    )
    commits = spark.sql(
        "select timestamp'2024-01-01' + make_dt_interval(id) as committed_at, id as version "
        "from range(10)"
    )
    audit = history.storage_audit(files, commits, ["part"]).first()
    assert (audit["snapshots"], audit["live_files"], audit["all_files"]) == (10, 3, 4)
    assert (audit["live_bytes"], audit["held_by_history"]) == (110, 100)
    assert audit["overhead_pct"] == pytest.approx(100 / 110 * 100)

    def expirable(as_of, days, keep):
        return history.retention_plan(commits, as_of, days, keep).first()["expirable"]

    assert expirable("2024-02-15 00:00:00", 30, 5) == 5
    assert expirable("2024-02-02 00:00:00", 30, 5) == 2
    assert expirable("2024-02-15 00:00:00", 30, 50) == 0
    assert [r["version"] for r in history.latest_commits(commits, 2).collect()] == [9, 8]


def test_every_label_is_reported(spark):
    rows = [(True, 5.0), (False, None), (None, 2.0), (None, 4.0)]
    stats = profiling.amount_stats(spark.createDataFrame(rows, "is_fraud boolean, amount double").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")))
    assert {r["is_fraud"]: r["median_amount"] for r in stats.collect()} == {True: 5.0, False: None, None: 3.0}
