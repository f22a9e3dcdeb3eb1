"""Streams: exactly once, replay, poison messages, and agreement with the batch rules."""

from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import txns
from ledgerlens.contracts import Contract
from ledgerlens.operators import detection as d
from ledgerlens.operators.transactions import conform, replay_messages, stream_positions
from ledgerlens.plans.monitoring import run_stream, start_stream
from ledgerlens.sources import files
from ledgerlens.streaming import alerts, bronze, dedupe, ledger, silver

GOOD = (
    '{"step": 1, "type": "TRANSFER", "amount": 5000.0, "name_orig": "C1", '
    '"old_balance_orig": 5000.0, "new_balance_orig": 0.0, "name_dest": "C2", '
    '"old_balance_dest": 0.0, "new_balance_dest": 5000.0, "is_fraud": 1}'
)
FULL = ("old_balance_dest", "new_balance_dest")


def log(spark, n=100, start=0, **changes):
    rows = txns(spark, *[
        {"step": 1 + i // 10, "amount": 100 + i, "old_balance_orig": 100 + i if i % 4 == 0 else 900,
         "new_balance_orig": 0 if i % 4 == 0 else 800 - i, "name_orig": f"C{i % 7}",
         "is_fraud": int(i % 4 == 0), **changes}
        for i in range(start, start + n)
    ])
    return rows.withColumns({
        **{c: F.lit(1.0) for c in FULL},
        "kafka_offset": (F.col("amount") - 100).cast("bigint"),
    })


def message_files(spark, root, df):
    bronze.write_replay(df, f"{root}/messages")
    return bronze.file_messages(spark, f"{root}/messages")


def test_replay_messages_are_keyed_ordered_and_complete(spark):
    df = log(spark)
    head = replay_messages(df, limit=15).orderBy("step", "position").collect()
    assert len(head) == 15 and [r["position"] for r in head] == list(range(15))
    assert head[3]["key"] == "C3" and '"name_orig":"C3"' in head[3]["value"]
    parts = bronze.as_messages(df).groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert {r["n"] for r in parts.collect()} == {1}


def test_written_replay_is_in_event_order_within_files(spark, root):
    bronze.write_replay(log(spark), f"{root}/m")
    rows = spark.read.parquet(f"{root}/m").select("offset", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["f"], []).append(r["offset"])
    assert all(v == sorted(v) for v in by_file.values()) and len(rows) == 100


def test_stream_equals_batch_and_a_rerun_adds_nothing(spark, root):
    messages = message_files(spark, root, log(spark))
    for _ in range(2):
        run_stream(spark, messages, f"{root}/lake")
    stored = silver.read_silver(spark, f"{root}/lake/silver")
    row = stream_positions(stored).first()
    assert (row["row_count"], row["position_count"]) == (100, 100)
    assert stored.agg(F.sum("amount")).first()[0] == D("14950.00")
    alerts.start_sweep(
        silver.bronze_stream(spark, f"{root}/lake/silver"), f"{root}/sweep", f"{root}/c_sweep"
    ).awaitTermination()
    streamed = spark.read.parquet(f"{root}/sweep")
    batch = d.sweep_alerts(stored).select(*alerts.SWEEP_COLUMNS)
    assert streamed.count() == 25
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_new_messages_are_picked_up_once(spark, root):
    run_stream(spark, message_files(spark, root, log(spark, 50)), f"{root}/lake")
    run_stream(spark, message_files(spark, root, log(spark, 50, start=50)), f"{root}/lake")
    stored = silver.read_silver(spark, f"{root}/lake/silver")
    assert stream_positions(stored).first().asDict() == {"row_count": 100, "position_count": 100}


def test_a_lost_checkpoint_does_not_duplicate_silver(spark, root):
    messages = message_files(spark, root, log(spark, 60))
    run_stream(spark, messages, f"{root}/lake")
    bad = log(spark, 1, start=70, type="REFUND")
    run_stream(spark, message_files(spark, root, bad), f"{root}/lake")
    late = message_files(spark, root, log(spark, 40, start=60).filter("kafka_offset <> 70"))
    bronze.run_bronze(late, f"{root}/lake/bronze", f"{root}/lake/checkpoints/bronze")
    # Silver is restarted from the beginning of bronze under a new checkpoint.
    for checkpoint in ("lost-1", "lost-2"):
        silver.run_silver(
            silver.bronze_stream(spark, f"{root}/lake/bronze"), f"{root}/lake/silver",
            f"{root}/lake/quarantine", f"{root}/{checkpoint}",
        )
    stored = silver.read_silver(spark, f"{root}/lake/silver")
    assert stream_positions(stored).first().asDict() == {"row_count": 99, "position_count": 99}
    assert silver.read_silver(spark, f"{root}/lake/quarantine").count() == 1


@pytest.mark.parametrize("change", ["content", "timestamp"])
def test_a_recreated_topic_is_not_taken_for_a_replay(spark, root, change):
    contract = Contract.named(silver.CONTRACT)
    handle = silver.batch_writer(contract, f"{root}/silver", f"{root}/quarantine")
    first = bronze.parse(bronze.as_messages(log(spark, 20)))
    again = first.withColumn("is_fraud", 1 - F.col("is_fraud")) if change == "content" else first.withColumn(
        "kafka_timestamp", F.lit("2019-01-01").cast("timestamp"))
    context = spark.sparkContext
    try:
        context.setLocalProperty("sql.streaming.queryId", "one")
        handle(first, 0)
        context.setLocalProperty("sql.streaming.queryId", "two")
        with pytest.raises(RuntimeError, match="other content"):
            handle(again, 0)
        handle(first, 0)
        assert silver.read_silver(spark, f"{root}/silver").count() == 20
        # With dedupe both messages of a position are kept; only copies are merged.
        silver.batch_writer(contract, f"{root}/s", f"{root}/q", dedupe=True)(first.union(again).union(first), 0)
        assert silver.read_silver(spark, f"{root}/s").count() == 40
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_a_new_lineage_compares_with_both_tables(spark, root):
    """The rules change between the runs, so messages would change tables."""
    strict = Contract.named(silver.CONTRACT)
    lax = replace(strict, row_rules={k: v for k, v in strict.row_rules.items() if k != "amount_positive"})
    batch = bronze.parse(bronze.as_messages(log(spark, 20))).withColumn(
        "amount", F.when(F.col("kafka_offset") < 5, 0.0).otherwise(F.col("amount")))
    context = spark.sparkContext
    try:
        for lake, contracts in (("a", (lax, strict)), ("b", (strict, lax))):
            for name, contract in zip(("one", "two"), contracts):
                context.setLocalProperty("sql.streaming.queryId", name)
                silver.batch_writer(contract, f"{root}/{lake}/s", f"{root}/{lake}/q")(batch, 0)
            kept = silver.read_silver(spark, f"{root}/{lake}/s").count()
            counts = [f for f in files.children(spark, f"{root}/{lake}/q") if f.startswith("query_id=")]
            bad = silver.read_silver(spark, f"{root}/{lake}/q").count() if counts else 0
            assert kept + bad == 20
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_a_retried_batch_overwrites_itself(spark, root):
    handle = silver.batch_writer(
        Contract.named(silver.CONTRACT), f"{root}/silver", f"{root}/quarantine"
    )
    batch = bronze.parse(bronze.as_messages(log(spark, 20)))
    handle(batch, 7)
    handle(batch, 7)
    assert silver.read_silver(spark, f"{root}/silver").count() == 20
    stored = spark.read.parquet(f"{root}/silver")
    assert {r["batch_id"] for r in stored.select("batch_id").distinct().collect()} == {7}


def test_copies_within_a_batch_are_merged_on_request(spark, root):
    batch = bronze.parse(bronze.as_messages(log(spark, 20)))
    twice = batch.unionByName(batch)
    contract = Contract.named(silver.CONTRACT)
    silver.batch_writer(contract, f"{root}/s", f"{root}/q", dedupe=True)(twice, 0)
    assert silver.read_silver(spark, f"{root}/s").count() == 20
    silver.batch_writer(contract, f"{root}/s2", f"{root}/q2")(twice, 0)
    row = stream_positions(silver.read_silver(spark, f"{root}/s2")).first()
    assert (row["row_count"], row["position_count"]) == (40, 20)


def test_a_bronze_sink_without_its_checkpoint_is_refused(spark, root):
    messages = message_files(spark, root, log(spark, 10))
    bronze.run_bronze(messages, f"{root}/b", f"{root}/c1")
    with pytest.raises(RuntimeError, match="another checkpoint"):
        bronze.run_bronze(messages, f"{root}/b", f"{root}/c2")


@pytest.mark.parametrize("value, broken", [
    (GOOD, 0),
    (GOOD[:60], 11),
    ("TRANSFER,5000,C1,C2", 11),
    ("", 11),
    (GOOD.replace('"name_dest": "C2", ', ""), 2),
    (GOOD.replace('"amount": 5000.0', '"amount": "five thousand"'), 1),
    (GOOD[:-1] + ', "channel": "mobile"}', 0),
])
def test_poison_messages(spark, value, broken):
    message = spark.createDataFrame([(value.encode(), 0, 3)], "value binary, partition int, offset bigint")
    parsed = bronze.parse(message.withColumn("timestamp", F.lit(None).cast("timestamp")))
    assert parsed.count() == 1
    passed, quarantined = Contract.named(silver.CONTRACT).enforce(
        conform(parsed), carry=["kafka_partition"]
    )
    if broken:
        row = quarantined.first()
        assert len(row["failed_rules"]) == broken and row["kafka_offset"] == 3
    else:
        assert passed.first()["kafka_offset"] == 3 and "channel" not in passed.columns
    kept = bronze.parse(
        message.withColumn("timestamp", F.lit(None).cast("timestamp")), skip_malformed=True
    ).count()
    assert kept == (0 if broken == 11 else 1)


def silver_files(spark, path, *rows):
    """Each row set lands as one file, so that each becomes one micro-batch."""
    for df in rows:
        df.coalesce(1).write.mode("append").parquet(path)
    return (
        spark.readStream.schema(rows[0].schema).option("maxFilesPerTrigger", 1)
        .option("latestFirst", "false").parquet(path)
    )


@pytest.mark.parametrize("rule", ["velocity", "structuring"])
def test_windowed_rules_stream_like_batch(spark, root, rule):
    if rule == "velocity":
        start, batch_rule = alerts.start_velocity, d.velocity_alerts
        rows = txns(spark, *[{"step": s, "amount": 600_000, "name_orig": a}
                             for s in (1, 2, 3, 9) for a in "AB"])
    else:
        start, batch_rule = alerts.start_structuring, d.structuring_alerts
        rows = txns(spark, *[{"step": s, "amount": 170_000, "name_orig": a}
                             for s in (1, 2, 3, 30, 31, 32) for a in "AB"])
    # A later monitored transaction moves the watermark past every window above.
    sentinel = txns(spark, {"step": 500, "amount": 170_000, "name_orig": "Z"})
    stream = silver_files(spark, f"{root}/s", rows, sentinel)
    start(stream, f"{root}/out", f"{root}/ck").awaitTermination()
    streamed = spark.read.parquet(f"{root}/out")
    batch = batch_rule(rows)
    assert batch.count() > 0
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_sweep_runs_on_parsed_messages_too(spark, root):
    messages = message_files(spark, root, log(spark, 40))
    parsed = bronze.parse(messages, skip_malformed=True)
    alerts.start_sweep(parsed, f"{root}/out", f"{root}/ck").awaitTermination()
    stored = spark.read.parquet(f"{root}/out")
    assert stored.columns == alerts.SWEEP_COLUMNS and stored.count() == 10


def test_both_stages_run_side_by_side(spark, root):
    messages = message_files(spark, root, log(spark, 30))
    queries = start_stream(spark, messages, f"{root}/lake")
    try:
        for query in queries:
            query.processAllAvailable()
        queries[1].processAllAvailable()
        stored = silver.read_silver(spark, f"{root}/lake/silver")
        assert stream_positions(stored).first().asDict() == {"row_count": 30, "position_count": 30}
    finally:
        for query in queries:
            query.stop()


def test_a_column_added_later_reads_as_null(spark, root):
    log(spark, 5).drop("kafka_offset").write.parquet(f"{root}/old")
    log(spark, 5).write.mode("append").parquet(f"{root}/old")
    declared = "step int, kafka_offset bigint"
    rows = spark.read.schema(declared).parquet(f"{root}/old")
    assert rows.count() == 10 and rows.filter("kafka_offset is null").count() == 5
    stream = silver.bronze_stream(spark, f"{root}/old", declared)
    assert stream.isStreaming and stream.columns == ["step", "kafka_offset"]


def test_open_windows_are_not_emitted(spark, root):
    rows = txns(spark, *[{"step": 10, "amount": 2_000_000}])
    stream = silver_files(spark, f"{root}/s", rows)
    alerts.start_velocity(stream, f"{root}/out", f"{root}/ck").awaitTermination()
    assert not files.exists(spark, f"{root}/out") or spark.read.parquet(f"{root}/out").isEmpty()


def test_late_data_beyond_the_watermark_is_left_out(spark, root):
    first = txns(spark, {"step": 100, "amount": 2_000_000, "name_orig": "A"})
    late = txns(spark, {"step": 1, "amount": 2_000_000, "name_orig": "LATE"})
    # A batch judges lateness by the watermark of the batch before it.
    between = txns(spark, {"step": 101, "amount": 1, "name_orig": "B"})
    sentinel = txns(spark, {"step": 900, "amount": 170_000, "name_orig": "Z"})
    stream = silver_files(spark, f"{root}/s", first, between, late, sentinel)
    alerts.start_velocity(stream, f"{root}/out", f"{root}/ck").awaitTermination()
    assert {r["name_orig"] for r in spark.read.parquet(f"{root}/out").collect()} == {"A"}


def test_intervals_merge_and_tell_what_overlaps(spark, root):
    path = f"{root}/silver"
    rows = spark.createDataFrame([(0, 0), (0, 4), (1, 7)], "kafka_partition int, kafka_offset bigint")
    ledger.record(rows, path, "one", 0)
    ledger.record(rows.withColumn("kafka_offset", F.col("kafka_offset") + 5), path, "one", 1)
    ledger.record(rows.withColumn("kafka_offset", F.col("kafka_offset") + 50), path, "one", 2)
    # A second attempt of a batch replaces the first one's intervals.
    ledger.record(rows.withColumn("kafka_offset", F.col("kafka_offset") + 20), path, "one", 2)
    found = ledger.others(spark, path, "two", (path,))
    assert sorted(found) == [("one", 0, 0, 9), ("one", 0, 20, 24), ("one", 1, 7, 7), ("one", 1, 12, 12), ("one", 1, 27, 27)]
    assert ledger.others(spark, path, "one", (path,)) == []
    assert ledger.overlapping([("two", 0, 10, 19)], found) == set()
    assert ledger.overlapping([("two", 0, 9, 19)], found) == {"one"}
    assert ledger.overlapping([("two", None, None, None)], found) == set()
    assert ledger.batches(spark, path, [("two", 0, 9, 9)], {"one"}) == [("one", 1)]


def test_stored_rows_are_read_only_where_intervals_overlap(spark, root, monkeypatch):
    handle = silver.batch_writer(Contract.named(silver.CONTRACT), f"{root}/s", f"{root}/q")
    read, batch = [], bronze.parse(bronze.as_messages(log(spark, 40)))
    stored = silver._stored_rows
    monkeypatch.setattr(silver, "_stored_rows", lambda like, paths, found: read.append(found) or stored(like, paths, found))
    context = spark.sparkContext
    try:
        context.setLocalProperty("sql.streaming.queryId", "one")
        handle(batch.filter("kafka_offset < 10"), 0)
        handle(batch.filter("kafka_offset between 10 and 19"), 1)
        assert read == []
        context.setLocalProperty("sql.streaming.queryId", "two")
        handle(batch.filter("kafka_offset >= 30"), 0)
        assert read == []
        handle(batch.filter("kafka_offset between 15 and 29"), 1)
        assert read == [[("one", 1)]]
        # A lineage from before there was a ledger is compared as a whole.
        files.remove(spark, ledger.ledger_path(f"{root}/s") + "/query_id=one")
        context.setLocalProperty("sql.streaming.queryId", "three")
        handle(batch, 0)
        assert ("one", None) in read[-1]
        row = stream_positions(silver.read_silver(spark, f"{root}/s")).first()
        assert (row["row_count"], row["position_count"]) == (40, 40)
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_replays_are_dropped_on_the_stream_and_leave_the_state(spark, root):
    parsed = bronze.parse(bronze.as_messages(log(spark, 40)))
    days = lambda n: F.col("kafka_timestamp") + F.make_interval(days=F.lit(n))
    first, later = parsed.filter("kafka_offset < 20"), parsed.filter("kafka_offset >= 20")
    again = first.withColumn("kafka_timestamp", days(1) - F.expr("interval 1 hour"))
    stream = silver_files(spark, f"{root}/m", first, again, later.withColumn("kafka_timestamp", days(9)),
                          later.withColumn("kafka_timestamp", days(9)), later.limit(1).withColumn("kafka_timestamp", days(30)).withColumn("kafka_offset", F.lit(999).cast("bigint")))
    query = bronze.start_append(dedupe.without_replays(stream), f"{root}/out", f"{root}/ck")
    query.awaitTermination()
    row = stream_positions(spark.read.parquet(f"{root}/out")).first()
    assert (row["row_count"], row["position_count"]) == (41, 41)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(states) <= 41 and states[-1] < 25
