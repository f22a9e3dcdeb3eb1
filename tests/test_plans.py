"""The physical plans claimed in the README: what is pruned, pushed, broadcast, shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from frames import master, txns
from ledgerlens.functions.dates import MONTH_END, date_spine
from ledgerlens.operators import (
    detection, engine_input, exposure, history, portfolio, profiling, reports, rwa, screening,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    rows = txns(spark, {}, {"type": "PAYMENT"}).withColumns(
        {"old_balance_dest": F.lit(1.0), "new_balance_dest": F.lit(1.0), "kafka_offset": F.lit(1),
         "kafka_partition": F.lit(0)}
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_positions_for_many_dates_neither_shuffle_nor_join(spark):
    book = portfolio.positions(master(spark), date_spine("2018-01-31", "2018-12-31", MONTH_END))
    text = plan(book)
    assert "Exchange" not in text and "Join" not in text
    # The spine is a constant, not computed per row.
    assert "sequence(" not in text and "last_day" not in text


def test_credit_rows_flow_without_a_shuffle(spark):
    book = portfolio.portfolio_as_of(master(spark), "2018-12-31")
    sent = engine_input.build(exposure.conform(book), "2018-12-31")
    assert "Exchange" not in plan(rwa.run_engine(sent))


def test_rules_push_their_filters_and_read_only_their_columns(silver):
    text = plan(detection.sweep_alerts(silver))
    pushed = text[text.index("PushedFilters"):]
    assert "In(type" in pushed and "GreaterThan(old_balance_orig" in pushed
    assert "new_balance_dest" not in re.search(r"ReadSchema: (\S+)", text).group(1)
    text = plan(detection.velocity_alerts(silver))
    assert "In(type" in text
    assert "old_balance" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_windowed_rules_shuffle_once_after_a_partial_aggregate(silver):
    df = detection.velocity_alerts(silver)
    assert exchanges(df) == 1
    assert plan(df).count("partial_count(1)") == 1


def test_both_transaction_rules_share_one_scan(silver):
    df = detection.build_alerts(silver, (detection.SWEEP, detection.DRAIN))
    assert plan(df).count("FileScan") == 1 and exchanges(df) == 0


def test_as_of_reads_the_files_of_current_versions_only(spark, tmp_path):
    path, beside = str(tmp_path / "v"), str(tmp_path / "v_versions")
    rows = spark.range(40).select(
        (F.col("id") % 4).alias("part"), (F.col("id") % 5).alias("version"), F.col("id").alias("row"))
    rows.write.partitionBy("part", "version").parquet(path)
    stored = spark.read.parquet(path)
    history.validity(stored, ["part"]).write.parquet(beside)
    df = history.read_as_of(stored, ["part"], 2, intervals=spark.read.parquet(beside))
    text = plan(df)
    assert "Window" not in text and "dynamicpruning" in text
    assert {r["version"] for r in df.select("version").distinct().collect()} == {2}
    # Without stored metadata the window runs over versions, which have been collapsed before.
    text = plan(history.read_as_of(stored, ["part"], 2))
    assert re.search(r"Window [^\n]*\n(.*\n){1,8}?.*HashAggregate", text)


def test_latest_slice_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "rwa")
    spark.range(4).select(
        F.date_add(F.lit("2018-12-01").cast("date"), F.col("id").cast("int")).alias("reporting_date"),
        F.lit("A").alias("rating_grade"), *[F.lit(1).alias(c) for c in ("ead", "rwa", "capital_required")],
    ).write.partitionBy("reporting_date").parquet(path)
    text = plan(reports.latest_slice(spark.read.parquet(path), "reporting_date"))
    assert re.search(r"PartitionFilters: \[[^\]]*Subquery", text)


def test_screening_joins_by_key_and_scores_once(spark):
    dest = spark.createDataFrame([("M1", "a b", True)],
                                 "name_dest string, dest_name string, seeded_hit boolean")
    listed = spark.createDataFrame([("W", "a b", "P")],
                                   "entity_id string, name string, program string")
    small = plan(screening.screen(dest, listed))
    large = plan(screening.screen(dest, listed, broadcast_bytes=0))
    for text in (small, large):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert text.count("MapInArrow") == 1
    assert re.search(r"BroadcastHashJoin \[cls", small)
    assert not re.search(r"BroadcastHashJoin \[cls", large)


def test_screening_does_not_push_its_arrays_below_the_distinct(spark):
    dest = spark.createDataFrame([("M1", "a b", True)],
                                 "name_dest string, dest_name string, seeded_hit boolean")
    listed = spark.createDataFrame([("W", "a b", "P")],
                                   "entity_id string, name string, program string")
    text = plan(screening.screen(dest, listed))
    assert "isnotnull(array_sort" not in text and "isnotnull(aggregate(" not in text
    # Each side computes its characters once, after its distinct.
    assert not re.search(r"Filter .*array_sort", text)


def test_exact_profile_has_no_expand(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    assert "Expand" not in plan(profiling.profile_columns(df))
    assert exchanges(profiling.profile_columns(df, exact=False)) == 0


def test_median_windows_are_bounded_by_digits(spark):
    df = spark.createDataFrame([("g", 1.0)], "g string, v double").select(
        "g", F.col("v").cast("decimal(18,2)").alias("v")
    )
    text = plan(profiling.exact_median(df, "g", "v"))
    # Every window runs over a histogram of one digit, never over the values.
    assert "percentile" not in text
    assert all(re.search(r"d[012]#", w) for w in re.findall(r"Window \[.*", text))


def test_four_rules_take_two_scans_and_two_shuffles(silver):
    df = detection.build_alerts(silver, (detection.SWEEP, detection.DRAIN, detection.VELOCITY, detection.STRUCTURING))
    assert plan(df).count("FileScan") == 2 and exchanges(df) == 2


def test_capital_of_the_latest_date_takes_one_scan(spark, tmp_path):
    path = str(tmp_path / "rwa")
    spark.range(4).select(
        F.date_add(F.lit("2018-12-01").cast("date"), F.col("id").cast("int")).alias("reporting_date"),
        F.lit("A").alias("rating_grade"), *[F.lit(1).alias(c) for c in ("ead", "rwa", "capital_required")],
    ).write.parquet(path)
    text = plan(reports.capital_by_grade(spark.read.parquet(path)))
    assert text.count("FileScan") == 1 and "Subquery" not in text


def test_rwa_reads_only_keys_of_what_it_staged_before_publishing(spark, tmp_path, monkeypatch):
    from ledgerlens.contracts import Contract
    from ledgerlens.plans import credit

    sent = engine_input.build(exposure.conform(portfolio.portfolio_as_of(master(spark), "2018-12-31"), "snapshot_date"), "2018-12-31")
    sent.write.partitionBy("reporting_date").parquet(str(tmp_path / "in"))
    reads, checks = [], []
    rows, counted = credit.Staged._rows, Contract.assert_counted
    monkeypatch.setattr(credit.Staged, "_rows", lambda self, broken: reads.append(broken) or rows(self, broken))
    monkeypatch.setattr(Contract, "assert_counted", lambda self, kept, dropped, passed: checks.append(
        plan(passed.select(*self.grain).distinct())) or counted(self, kept, dropped, passed))
    outcome = credit.run_rwa(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "q"), "2018-12-31")
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert outcome.published == stored.count() > 0
    assert outcome.total_rwa == stored.agg(F.sum("rwa")).first()[0]
    # Once each for the quarantine, the grain and the publication.
    assert sorted(reads) == [False, False, True]
    assert re.search(r"ReadSchema: struct<reporting_date:date,exposure_id:string>", checks[0])
