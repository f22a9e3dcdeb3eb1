"""Run a job: `python -m ledgerlens <job> ...`, or through spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ledgerlens.functions.dates import DAILY, MONTH_END
from ledgerlens.operators.loans import raw_schema
from ledgerlens.plans import credit, monitoring
from ledgerlens.session import session
from ledgerlens.sources.files import read_csv
from ledgerlens.streaming.bronze import file_messages, kafka_messages
from ledgerlens.streaming.silver import read_silver


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerlens", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        return sub

    job("master", "csv", "out")
    snapshots = job("snapshots", "master", "bronze", "start", "end")
    snapshots.add_argument("--freq", choices=[DAILY, MONTH_END], default=DAILY)
    job("silver", "bronze", "silver", "quarantine", "date")
    job("engine-input", "silver", "out", "quarantine", "date")
    job("rwa", "input", "out", "quarantine", "date")
    stream = job("stream", "root")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--files", metavar="PATH")
    stream.add_argument("--continuous", action="store_true")
    alerts = job("alerts", "silver", "out")
    alerts.add_argument("--rules", nargs="+", choices=monitoring.ALL_RULES,
                        default=[monitoring.ALL_RULES[0]])
    screening = job("screen", "dest_names", "watchlist", "out")
    screening.add_argument("--threshold", type=float, default=monitoring.THRESHOLD)
    return parser


def run(spark: SparkSession, argv: Sequence[str]) -> str:
    """Run one job and return its summary line."""
    args = _parser().parse_args(argv)
    if args.job == "master":
        credit.build_master(read_csv(spark, args.csv, raw_schema()), args.out)
        return f"loans={spark.read.parquet(args.out).count():,}"
    if args.job == "snapshots":
        credit.build_snapshots(
            spark.read.parquet(args.master), args.bronze, args.start, args.end, args.freq
        )
        return f"{args.start} to {args.end} written"
    if args.job == "stream":
        messages = (
            kafka_messages(spark, args.kafka) if args.kafka else file_messages(spark, args.files)
        )
        if args.continuous:
            monitoring.start_stream(spark, messages, args.root)
            spark.streams.awaitAnyTermination()
        else:
            monitoring.run_stream(spark, messages, args.root)
        return f"streamed to {args.root}"
    if args.job == "alerts":
        found = monitoring.run_alerts(read_silver(spark, args.silver), args.out, args.rules)
        return f"alerts={found:,}"
    if args.job == "screen":
        hits = monitoring.run_screening(
            spark.read.parquet(args.dest_names), spark.read.parquet(args.watchlist), args.out,
            args.threshold,
        )
        return f"screening alerts (threshold {args.threshold}): {hits:,}"
    dated = {
        "silver": (credit.run_silver, "bronze", "silver"),
        "engine-input": (credit.run_engine_input, "silver", "out"),
        "rwa": (credit.run_rwa, "input", "out"),
    }
    job, source, target = dated[args.job]
    outcome = job(
        spark, getattr(args, source), getattr(args, target), args.quarantine, args.date
    )
    line = f"{args.date}  published={outcome.published:,}  quarantined={outcome.quarantined:,}"
    if outcome.total_rwa is not None:
        line += f"  total_rwa={outcome.total_rwa:,}"
    return line


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    spark = session("ledgerlens")
    try:
        print(run(spark, sys.argv[1:] if argv is None else argv))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
