"""The command line: a book from CSV to RWA, and a stream to alerts and screening."""

import csv

from pyspark.sql import functions as F

from frames import txns
from ledgerlens.__main__ import run
from ledgerlens.operators.loans import OUTCOME, STATIC
from ledgerlens.streaming import bronze


def test_book_from_csv_to_rwa(spark, root):
    loan = {
        "issue_d": "Jan-2018", "term": " 36 months", "loan_amnt": 1000, "int_rate": 12.0,
        "grade": "B", "sub_grade": "B1", "purpose": "car", "addr_state": "CA",
        "annual_inc": 1, "dti": 1, "fico_range_low": 700, "fico_range_high": 704,
        "loan_status": "Current", "home_ownership": "RENT", "emp_length": "1 year",
        "verification_status": "Verified", "application_type": "Individual",
    }
    with open(f"{root}/raw.csv", "w", newline="") as f:
        writer = csv.DictWriter(f, [*STATIC, *OUTCOME, "desc"], restval="")
        writer.writeheader()
        for i in range(5):
            writer.writerow({**loan, "id": str(i), "desc": "free text"})
        writer.writerow({"id": "Total amount funded"})
    assert run(spark, ["master", f"{root}/raw.csv", f"{root}/master"]) == "loans=5"
    master = spark.read.parquet(f"{root}/master")
    assert len(master.columns) == 27 and "desc" not in master.columns
    run(spark, ["snapshots", f"{root}/master", f"{root}/bronze", "2018-11-30", "2018-12-31",
                "--freq", "ME"])
    day = "2018-12-31"
    assert "published=5" in run(
        spark, ["silver", f"{root}/bronze", f"{root}/silver", f"{root}/q1", day])
    assert "published=5" in run(
        spark, ["engine-input", f"{root}/silver", f"{root}/input", f"{root}/q2", day])
    line = run(spark, ["rwa", f"{root}/input", f"{root}/rwa", f"{root}/q3", day])
    total = spark.read.parquet(f"{root}/rwa").agg(F.sum("rwa")).first()[0]
    assert line == f"{day}  published=5  quarantined=0  total_rwa={total:,}"


def test_daily_snapshots_are_gathered_by_date(spark, root):
    from frames import master
    from ledgerlens.sources.files import file_inventory

    master(spark, *[{"exposure_id": f"LC-{i}"} for i in range(40)]).repartition(8).write.parquet(
        f"{root}/m")
    run(spark, ["snapshots", f"{root}/m", f"{root}/b", "2018-12-01", "2018-12-10"])
    assert spark.read.parquet(f"{root}/b").count() == 400
    assert file_inventory(spark, f"{root}/b").count() == 10


def test_stream_alerts_and_screening(spark, root):
    rows = txns(spark, {"amount": 500}, {"amount": 100}).withColumns(
        {"old_balance_dest": F.lit(0.0), "new_balance_dest": F.lit(1.0),
         "kafka_offset": F.col("amount").cast("bigint")}
    ).withColumn("new_balance_orig", F.col("old_balance_orig") - F.col("amount"))
    bronze.write_replay(rows, f"{root}/messages")
    run(spark, ["stream", f"{root}/lake", "--files", f"{root}/messages"])
    assert run(spark, ["alerts", f"{root}/lake/silver", f"{root}/alerts"]) == "alerts=1"
    spark.createDataFrame([("M1", "Tariq Kha", True)],
                          "name_dest string, dest_name string, seeded_hit boolean"
                          ).write.parquet(f"{root}/dest")
    spark.createDataFrame([("W", "Tariq Khan", "P")],
                          "entity_id string, name string, program string"
                          ).write.parquet(f"{root}/list")
    assert run(spark, ["screen", f"{root}/dest", f"{root}/list", f"{root}/hits"]).endswith(": 1")
