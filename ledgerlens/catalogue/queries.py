"""The registered queries: each takes (spark, sf_dir) and runs over the whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, TimestampNTZType, TimestampType

from ledgerlens.catalogue import views
from ledgerlens.catalogue.views import REPORTING_DATE
from ledgerlens.contracts import Contract, ContractViolation
from ledgerlens.contracts.contract import FAILED
from ledgerlens.functions.dates import MONTH_END
from ledgerlens.operators import (
    data_tests, detection, drift, engine_input, exposure, history, loans, portfolio, profiling,
    reports, rwa, screening, transactions,
)
from ledgerlens.plans import credit, monitoring
from ledgerlens.session import scratch_path, prepare
from ledgerlens.sources import files, landing
from ledgerlens.streaming import alerts as stream_alerts, bronze, dedupe, silver

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Event amounts stay under 500, so the amount limits of the rules are scaled to them.
VELOCITY = {"min_count": 3, "min_amount": 200}
STRUCTURING = {
    "threshold": 200, "band": Decimal("0.2"), "min_count": 2, "min_total": 100,
}
DRAIN_MINIMUM = 100
SCALED = {"velocity": VELOCITY, "structuring": STRUCTURING, "drain_minimum": DRAIN_MINIMUM}


def comparable(df: DataFrame) -> DataFrame:
    """Types every engine and client reads alike: doubles, and text for dates and arrays."""
    def cast(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(prepare(spark), sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# ---- loans and positions -------------------------------------------------------------


@query
def loan_master(spark, sf):
    return views.master(spark, sf)


@query
def loan_rejects(spark, sf):
    return loans.loan_rejects(views.raw_loans(spark, sf))


@query
def csv_loans(spark, sf):
    """The master from CSV extracts, half of them with their columns in another order."""
    root, raw = scratch_path(spark, "extracts"), views.raw_loans(spark, sf)
    names, odd = raw.columns, F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    raw.where(odd).select(*names).write.option("header", True).csv(f"{root}/year=1")
    raw.where(~odd).select(*sorted(names)).write.option("header", True).csv(f"{root}/year=2")
    return loans.loan_master(files.read_csv(spark, f"{root}/*", loans.raw_schema()))


@query
def portfolio_as_of(spark, sf):
    return rounded(
        views.book(spark, sf).select(
            "exposure_id", "status", "days_past_due", "default_flag", "outstanding_amount",
            "provision_amount", "snapshot_date",
        ),
        "outstanding_amount", "provision_amount", digits=2,
    )


@query
def portfolio_months(spark, sf):
    """All month-ends from one pass, the provision and balance in cents."""
    return rounded(
        views.books(spark, sf).select(
            "snapshot_date", "exposure_id", "status", "days_past_due", "outstanding_amount",
        ),
        "outstanding_amount", digits=2,
    )


@query
def portfolio_metrics(spark, sf):
    return rounded(
        portfolio.portfolio_metrics(views.silver_months(spark, sf)), "npl_pct"
    )


@query
def arrival_gaps(spark, sf):
    """Two of the seven month-ends asked for were never loaded."""
    return reports.arrival_gaps(
        views.silver_months(spark, sf), "snapshot_date", "1998-08-31", "1999-02-28", MONTH_END
    )


# ---- exposures and contracts ---------------------------------------------------------


@query
def conform_exposure(spark, sf):
    return views.silver(spark, sf)


def _silver_split(spark, sf):
    return exposure.validate(exposure.conform(views.broken_book(spark, sf), "snapshot_date"))


@query
def exposure_quarantine(spark, sf):
    return _silver_split(spark, sf)[1].select("exposure_id", "rating_grade", FAILED)


@query
def exposure_passed(spark, sf):
    return _silver_split(spark, sf)[0].select(
        "exposure_id", "status", "rating_grade", "outstanding_amount"
    )


@query
def quarantine_by_rule(spark, sf):
    return reports.quarantine_by_rule(_silver_split(spark, sf)[1])


@query
def quarantine_by_combination(spark, sf):
    return reports.quarantine_by_combination(_silver_split(spark, sf)[1])


@query
def quarantine_by_size(spark, sf):
    return reports.quarantine_by_size(_silver_split(spark, sf)[1])


@query
def engine_input_rows(spark, sf):
    return engine_input.build(views.silver(spark, sf), REPORTING_DATE)


@query
def contract_input_split(spark, sf):
    """Every exposure sent, with the rules it broke; empty text where it passed."""
    contract = Contract.named("credit_risk_exposure_input")
    broken = exposure.conform(views.broken_book(spark, sf))
    return contract.tag(engine_input.build(broken, REPORTING_DATE)).select(
        "exposure_id", FAILED
    )


@query
def contract_assertions(spark, sf):
    contract = Contract.named("credit_risk_exposure_input")
    broken = exposure.conform(views.broken_book(spark, sf))
    return rounded(
        contract.assertion_report(engine_input.build(broken, REPORTING_DATE)),
        "observed", "required",
    )


@query
def scope_report(spark, sf):
    return engine_input.scope_report(views.silver_months(spark, sf))


# ---- rwa -----------------------------------------------------------------------------


@query
def rwa_output(spark, sf):
    return views.rwa_output(spark, sf)


def _published_input(spark, sf, root: str):
    """Silver of the reporting date, stored, and the engine input published from it."""
    files.write_partitions(views.silver(spark, sf), f"{root}/silver", "snapshot_date")
    credit.run_engine_input(spark, f"{root}/silver", f"{root}/input", f"{root}/quarantine/input", REPORTING_DATE)


@query
def rwa_published(spark, sf):
    """The RWA slice that the chain of jobs publishes after contracts and reconciliation."""
    root = scratch_path(spark, "chain")
    _published_input(spark, sf, root)
    credit.run_rwa(spark, f"{root}/input", f"{root}/rwa", f"{root}/quarantine/rwa", REPORTING_DATE)
    return files.read_partition(spark, f"{root}/rwa", REPORTING_DATE, "reporting_date").select(
        "reporting_date", "exposure_id", "rating_grade", "ead", "rwa", "capital_required")


@query
def duplicate_halts(spark, sf):
    """What is published after a rerun whose silver holds every defaulted exposure twice: the
    job halts on its grain and the slice stays as it was."""
    root = scratch_path(spark, "halted")
    _published_input(spark, sf, root)
    once = views.silver(spark, sf)
    files.write_partitions(
        once.unionByName(once.where(F.col("status") == "defaulted")), f"{root}/silver", "snapshot_date")
    try:
        credit.run_engine_input(spark, f"{root}/silver", f"{root}/input", f"{root}/quarantine/input", REPORTING_DATE)
        halted = "published"
    except ContractViolation as broken:
        halted = re.search(r"\d+ rows duplicate the grain", str(broken))[0]
    return spark.read.parquet(f"{root}/input").groupBy("status").agg(
        F.count("*").alias("row_count"), F.sum("outstanding_amount").alias("balance"), F.lit(halted).alias("halt"))


@query
def schema_breaks(spark, sf):
    """For each column of the engine input: is a delivery without it refused before any job?"""
    contract, sent = Contract.named("credit_risk_exposure_input"), engine_input.build(views.silver(spark, sf), REPORTING_DATE)
    refused = []
    for name in sent.columns:
        try:
            contract.enforce(sent.drop(name))
            refused.append((name, "accepted"))
        except ContractViolation as broken:
            refused.append((name, "refused" if f"['{name}']" in str(broken) else str(broken)))
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(o).alias("outcome")) for n, o in refused]))
    return sent.agg(F.count("*").alias("row_count")).select(named.alias("r"), "row_count").select("r.*", "row_count")


@query
def total_rwa(spark, sf):
    return rwa.total_rwa(views.rwa_output(spark, sf))


def _faulty_return(spark, sf):
    """What came back, with some grades lost and one grade's EAD changed."""
    sent = engine_input.build(views.silver(spark, sf), REPORTING_DATE)
    returned = rwa.run_engine(sent).filter(
        (F.col("rating_grade") != "G") | (F.col("status") != "performing")
    ).withColumn(
        "ead",
        F.when(
            F.col("rating_grade") == "C", F.col("ead") + F.lit(Decimal("0.50"))
        ).otherwise(F.col("ead")),
    )
    return sent, returned


@query
def reconcile_totals(spark, sf):
    return rwa.reconciliation_totals(*_faulty_return(spark, sf))


@query
def reconcile_breaks(spark, sf):
    return rwa.reconciliation_breaks(*_faulty_return(spark, sf))


@query
def rwa_monthly_trend(spark, sf):
    return reports.rwa_monthly_trend(views.rwa_months(spark, sf))


@query
def capital_by_grade(spark, sf):
    return reports.capital_by_grade(views.rwa_months(spark, sf))


# ---- transactions and detection ------------------------------------------------------


@query
def conform_txn(spark, sf):
    return views.silver_txn(spark, sf)


@query
def txn_contract_split(spark, sf):
    contract = Contract.named("txn_monitoring_transaction")
    return contract.tag(
        transactions.conform(views.broken_txn(spark, sf)), carry=["kafka_partition"]
    ).select("kafka_partition", "kafka_offset", FAILED)


@query
def poison_payloads(spark, sf):
    """How many rules each kind of spoiled message breaks."""
    parsed = transactions.conform(bronze.parse(views.poisoned_messages(spark, sf)))
    contract = Contract.named("txn_monitoring_transaction")
    return (
        contract.tag(parsed, carry=["kafka_partition"])
        .groupBy(F.col("kafka_partition").alias("kind"), F.size(FAILED).alias("broken"))
        .agg(F.count("*").alias("row_count"))
    )


@query
def skip_malformed(spark, sf):
    """Messages left when unreadable ones are skipped."""
    return bronze.parse(views.poisoned_messages(spark, sf), skip_malformed=True).select(
        "kafka_offset", "step", "type", "name_orig"
    )


@query
def sweep_alerts(spark, sf):
    return detection.sweep_alerts(views.silver_txn(spark, sf))


@query
def drain_alerts(spark, sf):
    return detection.drain_alerts(views.silver_txn(spark, sf), DRAIN_MINIMUM)


@query
def velocity_alerts(spark, sf):
    return detection.velocity_alerts(views.silver_txn(spark, sf), **VELOCITY)


@query
def structuring_alerts(spark, sf):
    return detection.structuring_alerts(views.silver_txn(spark, sf), **STRUCTURING)


def _alerts(spark, sf):
    return detection.build_alerts(views.silver_txn(spark, sf), monitoring.ALL_RULES, **SCALED)


@query
def alerts_all(spark, sf):
    return _alerts(spark, sf).select(
        "step", "name_orig", F.coalesce("name_dest", F.lit("-")).alias("name_dest"),
        F.coalesce("type", F.lit("-")).alias("type"), "amount", "rule", "label",
    )


@query
def rule_scorecard(spark, sf):
    silver_txn = views.silver_txn(spark, sf)
    alerts = detection.build_alerts(
        silver_txn, (detection.SWEEP, detection.DRAIN), drain_minimum=DRAIN_MINIMUM
    )
    return rounded(detection.rule_scorecard(alerts, silver_txn), "recall", "precision")


@query
def flag_baseline(spark, sf):
    return rounded(detection.flag_baseline(views.bronze_txn(spark, sf)), "flag_recall_pct")


@query
def alerts_by_rule(spark, sf):
    return reports.alerts_by_rule(_alerts(spark, sf))


@query
def alerts_by_type(spark, sf):
    alerts = detection.build_alerts(
        views.silver_txn(spark, sf), (detection.SWEEP, detection.DRAIN),
        drain_minimum=DRAIN_MINIMUM,
    )
    return reports.alerts_by_type(alerts)


# ---- screening -----------------------------------------------------------------------


def _hits(spark, sf):
    return screening.screen(views.dest_names(spark, sf), views.watchlist(spark, sf))


@query
def watchlist_screen(spark, sf):
    return _hits(spark, sf)


@query
def watchlist_screen_shuffled(spark, sf):
    """The same screening with the list too large to broadcast, at a lower threshold."""
    return screening.screen(
        views.dest_names(spark, sf), views.watchlist(spark, sf), threshold=0.85,
        broadcast_bytes=0,
    )


@query
def screen_top10(spark, sf):
    return screening.top_hits(_hits(spark, sf))


# ---- drift and profiles --------------------------------------------------------------


def _measures():
    return {
        "exposure_count": F.count("*"),
        "total_ead": F.sum("ead"),
        "total_rwa": F.sum("rwa"),
    }


@query
def drift_measures(spark, sf):
    return rounded(
        drift.period_measures(views.rwa_months(spark, sf), "reporting_date", _measures()),
        "value", digits=2,
    )


@query
def drift_moves(spark, sf):
    measured = drift.period_measures(
        views.rwa_months(spark, sf), "reporting_date", _measures()
    )
    return rounded(
        drift.period_drift(measured, tolerance=0.05).withColumn(
            "kind", F.coalesce("kind", F.lit("within"))
        ),
        "ratio",
    )


@query
def drift_breaches(spark, sf):
    """December delivered in cents: every rule passes, the drift monitor does not."""
    scale = F.when(
        F.col("reporting_date") == F.lit(REPORTING_DATE).cast("date"), 100
    ).otherwise(1)
    faulty = views.rwa_months(spark, sf).withColumns(
        {c: F.col(c) * scale for c in ("ead", "rwa")}
    )
    measured = drift.period_measures(faulty, "reporting_date", _measures())
    return rounded(drift.period_breaches(measured), "ratio")


@query
def profile_columns(spark, sf):
    """Every column of the raw extract, counted over the whole of it."""
    return rounded(
        profiling.profile_columns(views.raw_loans(spark, sf)).drop("data_type"), "non_null_pct"
    )


@query
def null_rates(spark, sf):
    return rounded(profiling.null_rates(views.raw_loans(spark, sf)), "null_pct")


@query
def category_frequencies(spark, sf):
    return rounded(
        profiling.category_frequencies(
            views.raw_loans(spark, sf),
            ["grade", "loan_status", "term", "purpose", "application_type", "emp_length"],
        ),
        "share_pct",
    )


@query
def rows_per_year(spark, sf):
    return profiling.rows_per_year(views.raw_loans(spark, sf))


@query
def fraud_by_type(spark, sf):
    return rounded(
        profiling.fraud_by_type(views.silver_txn(spark, sf)), "fraud_pct", "avg_amount"
    )


@query
def amount_stats(spark, sf):
    return rounded(
        profiling.amount_stats(views.silver_txn(spark, sf)), "median_amount", "mean_amount"
    )


@query
def loan_amount_median(spark, sf):
    """Exact medians per grade, over amounts that spread through all digits."""
    priced = views.master(spark, sf).select(
        "grade", F.col("loan_amnt").cast("decimal(18,2)").alias("amount")
    )
    return rounded(profiling.exact_median(priced, "grade", "amount"), "median")


@query
def drain_signature(spark, sf):
    return rounded(profiling.drain_signature(views.silver_txn(spark, sf)), "drained_fraud_pct")


@query
def step_span(spark, sf):
    return rounded(profiling.step_span(views.silver_txn(spark, sf)), "span_days")


# ---- investigation -------------------------------------------------------------------


@query
def duplicate_grain(spark, sf):
    return reports.duplicate_grain(
        views.replayed_txn(spark, sf), ["name_orig", "step", "kafka_offset"]
    )


@query
def stream_positions(spark, sf):
    return transactions.stream_positions(views.replayed_txn(spark, sf))


@query
def dedupe_stream(spark, sf):
    return transactions.dedupe_stream(views.replayed_txn(spark, sf)).select(
        "kafka_partition", "kafka_offset", "type", "amount"
    )


@query
def report_tests(spark, sf):
    """Completeness and uniqueness of the four reporting models."""
    made = {
        "rwa_monthly_trend": reports.rwa_monthly_trend(views.rwa_months(spark, sf)),
        "capital_by_grade": reports.capital_by_grade(views.rwa_months(spark, sf)),
        "alerts_by_rule": reports.alerts_by_rule(_alerts(spark, sf)),
        "alerts_by_type": reports.alerts_by_type(_alerts(spark, sf)),
    }
    results = None
    for name, report in made.items():
        data_tests.forbid_identifiers(report)
        tested = data_tests.run_tests(report, data_tests.REPORT_TESTS[name]).select(
            F.lit(name).alias("model"), "*"
        )
        results = tested if results is None else results.unionByName(tested)
    return results


# ---- storage -------------------------------------------------------------------------


@query
def read_as_of(spark, sf):
    return history.read_as_of(views.versioned_rows(spark, sf), ["part"], 1998)


@query
def storage_audit(spark, sf):
    return rounded(
        history.storage_audit(
            views.versioned_rows(spark, sf), views.commits(spark, sf), ["part"]
        ),
        "overhead_pct",
    )


@query
def retention_plan(spark, sf):
    return history.retention_plan(views.commits(spark, sf), "1999-06-30 00:00:00")


@query
def latest_commits(spark, sf):
    return history.latest_commits(views.commits(spark, sf))


@query
def landing_plan(spark, sf):
    """October has not landed, December landed with other balances."""
    source = views.silver_months(spark, sf)
    landed = source.filter(F.col("snapshot_date") != F.lit("1998-10-31").cast("date")).withColumn(
        "outstanding_amount",
        F.when(
            F.col("snapshot_date") == F.lit(REPORTING_DATE).cast("date"),
            (F.col("outstanding_amount") * 2).cast("decimal(18,2)"),
        ).otherwise(F.col("outstanding_amount")),
    )
    return landing.landing_plan(source, landed)


@query
def partition_rerun(spark, sf):
    """Load all months, then rerun December with its performing loans only."""
    root = scratch_path(spark, "rerun")
    months = views.silver_months(spark, sf)
    files.write_partitions(months, root, "snapshot_date")
    smaller = files.read_partition(spark, root, REPORTING_DATE).filter(
        F.col("status") == "performing"
    )
    staged = scratch_path(spark, "rerun-stage")
    smaller.write.parquet(staged)
    files.replace_partition(
        spark.read.parquet(staged), root, "snapshot_date", REPORTING_DATE
    )
    return spark.read.parquet(root).groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.sum("outstanding_amount").alias("balance")
    )


def _balances(stored: DataFrame) -> DataFrame:
    return stored.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.sum("outstanding_amount").alias("balance")
    )


@query
def landed_partitions(spark, sf):
    """What is stored after a landing resumes: October was missing, December had fewer rows."""
    root, month = scratch_path(spark, "landing"), F.col("snapshot_date")
    with landing.staged(
        views.silver_months(spark, sf), scratch_path(spark, "landing-source")
    ) as source:
        earlier = source.filter(month != F.lit("1998-10-31").cast("date")).filter(
            (month != F.lit(REPORTING_DATE).cast("date")) | (F.col("status") == "performing")
        )
        landing.land(spark, earlier, root)
        landing.land(spark, source, root)
    return _balances(spark.read.parquet(root))


@query
def compacted_rows(spark, sf):
    """The months after compaction of their partitions."""
    root, out = scratch_path(spark, "loose"), scratch_path(spark, "compacted")
    files.write_partitions(views.silver_months(spark, sf), root, "snapshot_date")
    files.compact(spark, root, out, ["snapshot_date"])
    return _balances(spark.read.parquet(out))


@query
def alerts_published(spark, sf):
    """Stored alerts by rule, after a run of all rules and a rerun of two of them."""
    root, txn = scratch_path(spark, "published"), views.silver_txn(spark, sf)
    monitoring.run_alerts(txn, root, monitoring.ALL_RULES, **SCALED)
    monitoring.run_alerts(txn, root, (detection.SWEEP, detection.DRAIN), **SCALED)
    return spark.read.parquet(root).groupBy("rule").agg(F.count("*").alias("alert_count"))


# ---- streams -------------------------------------------------------------------------


REPLAY_HEAD = 500


@query
def replay_head(spark, sf):
    """The first messages of the log in event order, equal steps in source order."""
    return transactions.replay_messages(views.bronze_txn(spark, sf), limit=REPLAY_HEAD).select(
        "step", "position", "key"
    )


@query
def replay_messages(spark, sf):
    """The log as keyed messages, its numbers read back from the JSON."""
    log = transactions.replay_messages(views.bronze_txn(spark, sf))
    read = F.from_json("value", bronze.PAYLOAD)
    return log.select(
        "step", "position", "key", read["type"].alias("type"),
        read["amount"].alias("amount"), read["old_balance_orig"].alias("old_balance_orig"),
        read["name_dest"].alias("name_dest"), read["is_fraud"].alias("is_fraud"),
    )


def _streamed(spark: SparkSession, sf: str) -> str:
    """The whole log through messages, bronze and silver; returns the root they lie under."""
    root = scratch_path(spark, "stream")
    bronze.write_replay(views.bronze_txn(spark, sf), f"{root}/messages")
    monitoring.run_stream(spark, bronze.file_messages(spark, f"{root}/messages"), root)
    return root


@query
def stream_silver(spark, sf):
    return silver.read_silver(spark, f"{_streamed(spark, sf)}/silver").select(
        "step", "type", "amount", "name_orig", "name_dest", "is_fraud", "kafka_offset"
    )


@query
def stream_rerun(spark, sf):
    """Rows and positions stored after the same run twice, half of the log having come between."""
    root, txn = scratch_path(spark, "twice"), views.bronze_txn(spark, sf)
    late = F.col("kafka_offset") % 2 == 1
    bronze.write_replay(txn.filter(~late), f"{root}/messages")
    messages = bronze.file_messages(spark, f"{root}/messages")
    monitoring.run_stream(spark, messages, root)
    bronze.write_replay(txn.filter(late), f"{root}/messages")
    for _ in range(2):
        monitoring.run_stream(spark, messages, root)
    return transactions.stream_positions(silver.read_silver(spark, f"{root}/silver"))


@query
def stream_after_lost_checkpoint(spark, sf):
    """Silver after its checkpoint was lost and bronze, grown by half of the log, replayed."""
    root, txn = scratch_path(spark, "lost"), views.bronze_txn(spark, sf)
    late = F.col("kafka_offset") % 2 == 1
    bronze.write_replay(txn.filter(~late), f"{root}/messages")
    messages = bronze.file_messages(spark, f"{root}/messages")
    monitoring.run_stream(spark, messages, root)
    bronze.write_replay(txn.filter(late), f"{root}/messages")
    bronze.run_bronze(messages, f"{root}/bronze", f"{root}/checkpoints/bronze")
    silver.run_silver(
        silver.bronze_stream(spark, f"{root}/bronze", bronze.BRONZE), f"{root}/silver",
        f"{root}/quarantine", f"{root}/checkpoints/silver-new",
    )
    return silver.read_silver(spark, f"{root}/silver").select(
        "step", "type", "amount", "name_orig", "name_dest", "is_fraud", "kafka_offset"
    )


@query
def stream_dedupe(spark, sf):
    """Bronze of a log whose transfers were delivered twice, without the second ones."""
    root, txn = scratch_path(spark, "deduped"), views.bronze_txn(spark, sf)
    for rows in (txn, txn.filter(F.col("type") == "TRANSFER")):
        bronze.write_replay(rows, f"{root}/messages")
    dedupe.start_deduped(
        bronze.file_messages(spark, f"{root}/messages"), f"{root}/bronze", f"{root}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select("kafka_offset", "type", "amount", "name_orig")


@query
def stream_sweep(spark, sf):
    root = _streamed(spark, sf)
    stream_alerts.start_sweep(
        silver.bronze_stream(spark, f"{root}/silver"), f"{root}/sweep", f"{root}/checkpoints/sweep"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/sweep")


@query
def stream_velocity(spark, sf):
    """Windows closed by the watermark at the end of the log."""
    root = _streamed(spark, sf)
    stream_alerts.start_velocity(
        silver.bronze_stream(spark, f"{root}/silver"), f"{root}/velocity",
        f"{root}/checkpoints/velocity", **VELOCITY,
    ).awaitTermination()
    return spark.read.parquet(f"{root}/velocity")


@query
def stream_structuring(spark, sf):
    """All windows: the log is marked as ended after its last step."""
    root = _streamed(spark, sf)
    stored = silver.bronze_stream(spark, f"{root}/silver")
    last = silver.read_silver(spark, f"{root}/silver").agg(F.max("step")).first()[0]
    stream_alerts.mark_end(spark, f"{root}/ends", last, STRUCTURING["threshold"])
    stream_alerts.start_structuring(
        stored, f"{root}/structuring", f"{root}/checkpoints/structuring", ends=f"{root}/ends",
        **STRUCTURING,
    ).awaitTermination()
    return spark.read.parquet(f"{root}/structuring")
