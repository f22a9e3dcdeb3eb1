"""The credit chain end to end, and the faults it has to stop or survive."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import MASTER, MASTER_ROW, txns
from ledgerlens.contracts import ContractViolation
from ledgerlens.operators import drift
from ledgerlens.operators.detection import DRAIN, SWEEP
from ledgerlens.plans import credit, monitoring
from ledgerlens.sources import files

DEC, NOV = "2018-12-31", "2018-11-30"


@pytest.fixture
def lake(spark, root):
    """Bronze and silver for two month-ends of 200 loans."""
    loans = [
        {**MASTER_ROW, "exposure_id": f"LC-{i}", "customer_id": f"c{i}", "grade": "ABCDEFG"[i % 7]}
        for i in range(196)
    ] + [
        {**MASTER_ROW, "exposure_id": f"LC-D{i}", "customer_id": f"d{i}",
         "loan_status": "Charged Off", "last_pymnt_d": date(2018, 9, 1)}
        for i in range(4)
    ]
    credit.build_snapshots(spark.createDataFrame(loans, MASTER), f"{root}/bronze", NOV, DEC)
    for d in (NOV, DEC):
        credit.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/q_silver", d)
    return root


def engine_input(spark, root, d=DEC):
    return credit.run_engine_input(spark, f"{root}/silver", f"{root}/input", f"{root}/q_input", d)


def run_rwa(spark, root, d=DEC):
    return credit.run_rwa(spark, f"{root}/input", f"{root}/rwa", f"{root}/q_rwa", d)


def rewrite_silver(spark, root, change, d=DEC):
    changed = change(files.read_partition(spark, f"{root}/silver", d))
    changed.write.mode("overwrite").parquet(f"{root}/changed")
    files.replace_partition(
        spark.read.parquet(f"{root}/changed"), f"{root}/silver", "snapshot_date", d
    )


def test_chain(spark, lake):
    for d in (NOV, DEC):
        assert engine_input(spark, lake, d) == credit.Outcome(200, 0)
        outcome = run_rwa(spark, lake, d)
        assert (outcome.published, outcome.quarantined) == (200, 0)
    output = spark.read.parquet(f"{lake}/rwa")
    assert output.count() == 400
    december = output.filter(F.col("reporting_date") == DEC)
    assert december.agg(F.sum("rwa")).first()[0] == outcome.total_rwa
    assert december.filter("status = 'defaulted'").count() == 4


def test_rerun_converges(spark, lake):
    assert engine_input(spark, lake) == engine_input(spark, lake)
    assert spark.read.parquet(f"{lake}/input").count() == 200


def test_duplicate_grain_halts_and_keeps_what_was_published(spark, lake):
    engine_input(spark, lake)
    rewrite_silver(spark, lake, lambda df: df.union(df.limit(1)))
    with pytest.raises(ContractViolation, match="1 rows duplicate the grain"):
        engine_input(spark, lake)
    assert spark.read.parquet(f"{lake}/input").count() == 200


def corrupt(df, every):
    bad = F.pmod(F.xxhash64("exposure_id"), F.lit(every)) == 0
    return df.withColumn("rating_grade", F.when(bad, "Z").otherwise(F.col("rating_grade")))


def test_quarantine_is_written_before_the_halt_and_cleared_by_a_clean_run(spark, lake):
    original = files.read_partition(spark, f"{lake}/silver", DEC)
    original.write.parquet(f"{lake}/clean")
    rewrite_silver(spark, lake, lambda df: corrupt(df, 10))
    with pytest.raises(ContractViolation, match="of rows quarantined"):
        engine_input(spark, lake)
    evidence = spark.read.parquet(f"{lake}/q_input")
    assert evidence.count() > 2
    assert {tuple(r["failed_rules"]) for r in evidence.collect()} == {("rating_grade_allowed",)}
    assert not files.exists(spark, f"{lake}/input")
    # Fixed at the source: the rerun publishes, and the stale evidence goes.
    rewrite_silver(spark, lake, lambda _: spark.read.parquet(f"{lake}/clean"))
    assert engine_input(spark, lake).published == 200
    assert not files.exists(spark, f"{lake}/q_input/reporting_date={DEC}")


def test_schema_break_is_found_before_any_job(spark, lake):
    df = files.read_partition(spark, f"{lake}/silver", DEC)
    from ledgerlens.contracts import Contract
    from ledgerlens.operators.engine_input import build

    with pytest.raises(Exception, match="purpose"):
        build(df.drop("purpose"), DEC)
    with pytest.raises(ContractViolation, match="purpose"):
        Contract.named("credit_risk_exposure_input").enforce(build(df, DEC).drop("purpose"))


def test_absent_date_halts(spark, lake):
    with pytest.raises(ContractViolation, match="0 rows arrived"):
        engine_input(spark, lake, "2019-01-31")


def test_unit_fault_passes_every_rule_but_not_the_drift_monitor(spark, lake):
    engine_input(spark, lake, NOV)
    run_rwa(spark, lake, NOV)
    money = ("original_amount", "outstanding_amount", "provision_amount")
    rewrite_silver(spark, lake, lambda df: df.withColumns(
        {c: (F.col(c) * 100).cast("decimal(18,2)") for c in money}))
    assert engine_input(spark, lake).quarantined == 0
    assert run_rwa(spark, lake).quarantined == 0
    measures = {"exposure_count": F.count("*"), "ead": F.sum("ead"), "rwa": F.sum("rwa")}
    output = spark.read.parquet(f"{lake}/rwa")
    kinds = {"exposure_count": "unchanged", "ead": "drift", "rwa": "drift"}
    measured = drift.period_measures(output, "reporting_date", measures)
    assert {r["measure"]: r["kind"] for r in drift.period_breaches(measured).collect()} == kinds


def test_silver_quarantine_share(spark, lake):
    bronze = files.read_partition(spark, f"{lake}/bronze", DEC)
    bad = bronze.withColumn("days_past_due", F.when(F.col("grade") == "A", -1).otherwise(F.col("days_past_due")))
    bad.write.parquet(f"{lake}/bad")
    files.replace_partition(spark.read.parquet(f"{lake}/bad"), f"{lake}/bronze", "snapshot_date", DEC)
    outcome = credit.run_silver(spark, f"{lake}/bronze", f"{lake}/silver", f"{lake}/q_silver", DEC)
    assert outcome.quarantined == 28 and outcome.quarantined_pct == pytest.approx(14.0)
    assert files.read_partition(spark, f"{lake}/silver", DEC).count() == 172


def test_staging_is_left_nowhere(spark, lake, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr("ledgerlens.session.tempfile.mkdtemp", lambda prefix: str(shared))
    engine_input(spark, lake)
    with pytest.raises(ContractViolation):
        engine_input(spark, lake, "2019-01-31")
    assert not list(shared.iterdir())


def test_alert_table_drops_what_a_rule_no_longer_raises(spark, root):
    swept = txns(spark, {"amount": 500},
                 {"amount": 300_000, "old_balance_orig": 400_000, "new_balance_orig": 0})
    rules = (SWEEP, DRAIN)
    assert monitoring.run_alerts(swept, f"{root}/alerts", rules) == 2
    quiet = txns(spark, {"amount": 500})
    assert monitoring.run_alerts(quiet, f"{root}/alerts", rules) == 1
    stored = spark.read.parquet(f"{root}/alerts")
    assert [r["rule"] for r in stored.collect()] == [SWEEP]
    assert monitoring.run_alerts(txns(spark), f"{root}/alerts", rules) == 0


def test_screening_job(spark, root):
    dest = spark.createDataFrame([("M1", "Tariq Kha", True), ("M2", "Someone Else", False)],
                                 "name_dest string, dest_name string, seeded_hit boolean")
    listed = spark.createDataFrame([("W", "Tariq Khan", "P")],
                                   "entity_id string, name string, program string")
    assert monitoring.run_screening(dest, listed, f"{root}/hits") == 1
    assert monitoring.run_screening(dest, listed, f"{root}/hits") == 1


def test_amounts_stay_exact_through_the_chain(spark, lake):
    engine_input(spark, lake)
    run_rwa(spark, lake)
    row = spark.read.parquet(f"{lake}/rwa").filter("rating_grade = 'B' and status = 'performing'").first()
    assert row["rwa"] == (row["ead"] * D("0.35")).quantize(D("0.01"), rounding="ROUND_HALF_UP")
