"""Command-line entry: run the streaming job, a batch backfill, or reports.

  python -m eventlens.app stream --kafka broker:9092 --topic events \
      --out /shared/tables --checkpoints /shared/checkpoints [--bronze /shared/bronze]
  python -m eventlens.app stream --files /landing/topic --format text --out ... --checkpoints ...
  python -m eventlens.app batch --files /landing/topic --out /shared/tables [--bronze /shared/bronze]
      [--by-date [--days 2024-01-05 2024-01-06]]
  python -m eventlens.app report --tables /shared/tables [--panel rpt_amount_by_city ...]
  python -m eventlens.app correct --tables /shared/tables --bronze /shared/bronze
  python -m eventlens.app compact --tables /shared/tables [--name raw_transactions ...] [--full]
  python -m eventlens.app replay --tables /shared/tables [--source fallback|quarantine]

Paths should be shared storage on a cluster.  Every streaming query is
named and checkpointed below ``--checkpoints``, so a restart resumes.
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators import aggregates, parse
from .operators.bronze import read_kind, write_bronze
from .plans import reports
from .plans.pipeline import ALL_TABLES, JdbcTables, Pipeline, Tables
from .session import build_session
from .sources.files import read_messages
from .sources.kafka import KafkaSource
from .streaming import late, replay, store
from .streaming.runner import (
    AVAILABLE_NOW,
    STREAM_TABLES,
    ProgressLog,
    Trigger,
    start_late_pipeline,
    start_pipeline,
    start_pipeline_via_bronze,
    start_shared_pipeline,
    supervise,
)
from .streaming.sinks import JdbcTableSink, MergedTableSink, ParquetTableSink


def _source(spark, args, streaming: bool):
    if args.kafka:
        if not args.topic:
            raise SystemExit("--kafka needs --topic")
        src = KafkaSource(
            args.kafka,
            args.topic,
            starting_offsets=args.starting_offsets,
            fail_on_data_loss=args.fail_on_data_loss,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
        )
        return src.read(spark, streaming=streaming)
    return read_messages(
        spark, args.files, args.format, streaming=streaming, max_files_per_trigger=args.max_files_per_trigger
    )


def _add_source_args(p: argparse.ArgumentParser) -> None:
    g = p.add_mutually_exclusive_group(required=True)
    g.add_argument("--kafka", help="bootstrap servers")
    g.add_argument("--files", help="folder of topic files")
    p.add_argument("--topic", help="topic name (with --kafka)")
    p.add_argument("--format", default="text", choices=["text", "parquet"])
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--fail-on-data-loss", action="store_true")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    p.add_argument("--max-files-per-trigger", type=int, default=None)


def _add_jdbc_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--jdbc-user", default=None)
    p.add_argument("--jdbc-password-env", default=None, help="environment variable that holds the password")
    p.add_argument("--jdbc-driver", default=None)


def _jdbc_properties(args) -> dict[str, str]:
    import os

    given = {"user": args.jdbc_user, "driver": args.jdbc_driver}
    if args.jdbc_password_env:
        given["password"] = os.environ[args.jdbc_password_env]
    return {k: v for k, v in given.items() if v is not None}


def sink_of(args):
    """Sink per table for --jdbc-url or --merge-raw, or None for parquet tables."""
    if args.jdbc_url or not args.merge_raw:
        return jdbc_sink_of(args)
    return lambda t: (MergedTableSink if t in parse.RAW else ParquetTableSink)(args.out, t, args.fallback, args.quarantine)


def jdbc_sink_of(args):
    """Sink per table for --jdbc-url, or None for parquet tables."""
    if not args.jdbc_url:
        return None
    return lambda t: JdbcTableSink(
        args.out, t, args.fallback, args.quarantine, url=args.jdbc_url, **_jdbc_properties(args)
    )


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="eventlens")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="run the streaming job")
    _add_source_args(s)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--bronze", default=None, help="parse once into this bronze folder")
    s.add_argument("--fallback", default=None, help="default: <out>/_fallback")
    s.add_argument("--quarantine", default=None, help="default: <out>/_quarantine")
    s.add_argument("--jdbc-url", default=None, help="write the tables to this database; --out keeps fallback and quarantine")
    _add_jdbc_args(s)
    s.add_argument("--bronze-files-per-trigger", type=int, default=None)
    s.add_argument("--trigger", default="30 seconds")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--tables", nargs="*", default=list(STREAM_TABLES + tuple(parse.RAW)))
    s.add_argument("--shared", action="store_true", help="aggregates of one kind and window share a query (without --bronze)")

    s.add_argument("--late", action="store_true", help="keep late rows of the aggregates, for `correct`")
    s.add_argument("--merge-raw", action="store_true", help="merge raw tables into their dates, each key stored once")

    c = sub.add_parser("correct", help="compute windows touched by late rows again from bronze by date")
    c.add_argument("--tables", required=True, help="folder of result tables")
    c.add_argument("--bronze", required=True, help="bronze by date that holds the late rows' days")
    c.add_argument("--name", nargs="*", default=list(STREAM_TABLES))

    k = sub.add_parser("compact", help="merge the committed batches of streamed tables into date partitions")
    k.add_argument("--tables", required=True, help="folder of result tables")
    k.add_argument("--name", nargs="*", default=list(STREAM_TABLES + tuple(parse.RAW)))
    k.add_argument("--full", action="store_true", help="merge earlier compactions as well")

    y = sub.add_parser("replay", help="take fallback or quarantine back into the tables")
    y.add_argument("--tables", required=True, help="folder of result tables")
    y.add_argument("--name", nargs="*", default=list(STREAM_TABLES + tuple(parse.RAW)))
    y.add_argument("--source", choices=["fallback", "quarantine"], default="fallback")

    b = sub.add_parser("batch", help="backfill all result tables from stored messages")
    _add_source_args(b)
    b.add_argument("--out", required=True)
    b.add_argument("--bronze", default=None)
    b.add_argument("--tables", nargs="*", default=list(ALL_TABLES))
    b.add_argument("--by-date", action="store_true", help="partition bronze and tables by UTC date")
    b.add_argument("--days", nargs=2, default=None, metavar=("FIRST", "LAST"),
                   help="recompute only these UTC days (needs --by-date and --bronze)")

    r = sub.add_parser("report", help="run dashboard panels over stored tables")
    g = r.add_mutually_exclusive_group(required=True)
    g.add_argument("--tables", help="folder of result tables")
    g.add_argument("--jdbc-url", help="database of result tables")
    _add_jdbc_args(r)
    r.add_argument("--jdbc-partitions", type=int, default=8, help="tasks that share the read of a database table")
    r.add_argument("--panel", nargs="*", default=None)
    r.add_argument("--out", default=None, help="write the panels here instead of printing their rows")

    args = ap.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)

    if args.cmd == "stream":
        trigger = AVAILABLE_NOW if args.available_now else Trigger(args.trigger)
        progress = ProgressLog().attach(spark)
        messages = _source(spark, args, streaming=True)
        if args.bronze:
            queries = start_pipeline_via_bronze(
                messages, args.bronze, args.out, args.checkpoints, args.tables, trigger, args.fallback, args.quarantine,
                args.bronze_files_per_trigger, sink_of(args),
            )
        else:
            queries = (start_shared_pipeline if args.shared else start_pipeline)(
                messages, args.out, args.checkpoints, args.tables, trigger, args.fallback, args.quarantine,
                sink_of(args),
            )
        if args.late:
            queries += start_late_pipeline(lambda kind: aggregates.prepare(messages, kind), args.out, args.checkpoints, args.tables, trigger)
        try:
            supervise(spark, queries)
        finally:
            print(json.dumps({"progress": progress.totals}))
            progress.detach(spark)
        return 0

    if args.cmd == "correct":
        for name in args.name:
            kind = aggregates.SPECS[name].kind
            windows = late.correct(spark, args.tables, name, lambda days, kind=kind: read_kind(spark, args.bronze, kind, days=days))
            print(json.dumps({"table": name, "windows": windows}))
        return 0

    if args.cmd == "compact":
        for name in args.name:
            if store.has_manifest(spark, args.tables, name):
                entry = store.compact(spark, args.tables, name, full=args.full)
                print(json.dumps({"table": name, "rows": entry and entry["rows"]}))
        return 0

    if args.cmd == "replay":
        for name in args.name:
            print(json.dumps({"table": name, "taken": replay.replay(spark, args.tables, name, f"_{args.source}")}))
        return 0

    if args.cmd == "batch":
        messages = _source(spark, args, streaming=False)
        if args.days and not (args.by_date and args.bronze):
            ap.error("--days needs --by-date and --bronze")
        if args.bronze:
            write_bronze(messages, args.bronze, by_date=args.by_date)
            days = tuple(args.days) if args.days else None
            pipeline = Pipeline.from_bronze(spark, args.bronze, days=days)
        else:
            pipeline = Pipeline.from_messages(spark, messages)
        pipeline.materialize(args.out, args.tables, by_date=args.by_date)
        return 0

    if args.cmd == "report":
        stored = JdbcTables(spark, args.jdbc_url, _jdbc_properties(args), partitions=args.jdbc_partitions) if args.jdbc_url else Tables(spark, args.tables)
        if args.out:
            print(json.dumps(reports.refresh(stored, args.out, args.panel)))
            return 0
        for name in args.panel or reports.REPORTS:
            for row in reports.rows(stored, name):
                print(json.dumps({"panel": name, "row": row.asDict()}, default=str))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
