"""Command line: ``python -m epigauge <command> --help`` (or ``spark-submit`` with this file)."""

from __future__ import annotations

import argparse
from dataclasses import replace as replace_spec

from pyspark.sql import DataFrame, SparkSession, functions as F

from epigauge.operators.cleaning import cleaning_report, indicator_columns, keep_nonzero
from epigauge.plans.board import build_board
from epigauge.plans.scoring import score_windows
from epigauge.plans.training import Bundle, feature_importance, train_on_history
from epigauge.session import build_session, use_rocksdb_state
from epigauge.sources.records import encode, event_time
from epigauge.sources.replay import replay
from epigauge.sources.streams import file_records, kafka_records, kafka_send
from epigauge.sources.tables import read_csv, read_parquet, write_csv, write_parquet
from epigauge.spec import CALENDAR_DAYS, HEALTH
from epigauge.streaming.jobs import finish, start_surveillance
from epigauge.streaming.keeper import corrected, start_kept_surveillance
from epigauge.streaming.log import PredictionLog


def _read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path) if path.rstrip("/").endswith(".csv") else read_parquet(spark, path)


def _write(df: DataFrame, path: str) -> None:
    (write_csv if path.rstrip("/").endswith(".csv") else write_parquet)(df, path)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = _read(spark, args.input)
    numeric = indicator_columns(raw, HEALTH, exclude=args.exclude)
    cleaning_report(raw, numeric).show()
    _write(keep_nonzero(raw, numeric), args.output)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    bundle = train_on_history(_read(spark, args.input), legacy_invert=args.legacy_invert)
    bundle.save(spark, args.bundle)
    print(bundle.facts)
    feature_importance(bundle, spark).show(truncate=False)


def send(spark: SparkSession, args: argparse.Namespace) -> None:
    """Daily reports as messages, one date after the other, to a topic or a folder."""
    reports = read_csv(spark, args.input, HEALTH.record_schema())
    dated = reports.withColumn("day", event_time(F.col(HEALTH.time_text), HEALTH.time_format).cast("date"))
    messages = encode(dated, HEALTH, keep=("day",))

    def to_topic(one: DataFrame) -> None:
        kafka_send(one, args.servers, args.topic)

    for day in replay(messages, F.col("day"), args.folder, to_topic if args.topic else None):
        print(f"sent {day}")


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.rocksdb:
        use_rocksdb_state(spark)
    bundle = Bundle.load(spark, args.bundle)
    records = (
        kafka_records(spark, args.servers, args.topic, args.starting_offsets)
        if args.topic
        else file_records(spark, args.folder, args.files_per_batch)
    )
    if args.keep_late or args.calendar:
        log = PredictionLog(args.log, replace_spec(HEALTH, calendar=args.calendar))
        finish(
            start_kept_surveillance(
                records,
                log,
                args.quarantine,
                args.checkpoint,
                score=lambda sums: score_windows(sums, bundle),
                every=args.every,
                name="surveillance",
                state_partitions=args.state_partitions,
            )
        )
        return
    finish(
        start_surveillance(
            records,
            PredictionLog(args.log),
            args.quarantine,
            args.checkpoint,
            score=lambda sums: score_windows(sums, bundle),
            every=args.every,
            once_per_report=args.once_per_report,
            name="surveillance",
            missing_counts=args.missing_counts,
            full_windows=args.full_windows,
            state_partitions=args.state_partitions,
        )
    )


def late(spark: SparkSession, args: argparse.Namespace) -> None:
    """Windows of a log of kept windows, with the reports that came after their end added."""
    log = PredictionLog(args.log)
    states = log.windows(spark).unionByName(log.skipped(spark), allowMissingColumns=True)
    _write(corrected(states, log.late(spark), log.spec).drop("day_words"), args.output)


def serve(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, table in build_board(PredictionLog(args.log).latest(spark, finality=True)).items():
        _write(table, f"{args.output}/{name}")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    log = PredictionLog(args.log)
    print("compacted" if log.compact(spark) else "nothing to compact")
    if args.retain_after is not None:
        print(f"removed {log.retain(spark, args.retain_after)} folders")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="epigauge")
    commands = top.add_subparsers(required=True)

    def command(run, *required: str) -> argparse.ArgumentParser:
        added = commands.add_parser(run.__name__, help=run.__doc__)
        added.set_defaults(run=run)
        for name in required:
            added.add_argument(f"--{name}", required=True)
        return added

    def transport(added: argparse.ArgumentParser) -> None:
        added.add_argument("--servers", default="localhost:9092")
        where = added.add_mutually_exclusive_group(required=True)
        where.add_argument("--topic")
        where.add_argument("--folder")

    command(clean, "input", "output").add_argument("--exclude", action="append", default=[], help="a column that is no metric")
    command(train, "input", "bundle").add_argument("--legacy-invert", action="store_true")
    transport(command(send, "input"))
    live = command(stream, "bundle", "log", "quarantine", "checkpoint")
    transport(live)
    live.add_argument("--starting-offsets", default="latest")
    live.add_argument("--files-per-batch", type=int)
    live.add_argument("--every", help="processing interval; without it, work off what is there and stop")
    live.add_argument("--once-per-report", action="store_true")
    live.add_argument("--rocksdb", action="store_true")
    live.add_argument("--missing-counts", action="store_true", help="log how many values each sum lacks")
    live.add_argument("--full-windows", action="store_true", help="scale partly reported windows before scoring")
    live.add_argument("--state-partitions", type=int, help="fixed by the first start on a checkpoint")
    live.add_argument("--calendar", choices=list(CALENDAR_DAYS), help="windows by calendar instead of 30 days")
    live.add_argument("--keep-late", action="store_true", help="log reports that come after their window's end")
    command(late, "log", "output")
    command(serve, "log", "output")
    command(compact, "log").add_argument("--retain-after", type=float, help="delete folded folders after so many seconds")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
