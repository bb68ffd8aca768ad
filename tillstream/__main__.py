"""Command line: run the stream, build the fact table, or run the checks.

    spark-submit --packages <kafka and avro packages> -m tillstream ...
    python -m tillstream stream --raw /lake/raw --agg /lake/agg --rejects /lake/rejects
    python -m tillstream fact --raw /lake/raw --fact /lake/fact --lookback "1 hour"
    python -m tillstream checks --raw /lake/raw --fact /lake/fact --agg /lake/agg
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from tillstream.operators.column_tests import AGG_TESTS, FACT_TESTS, run_suite
from tillstream.operators.compaction import TARGET_BYTES, compact_days
from tillstream.operators.decode import AHEAD, BEHIND
from tillstream.operators.quality import QualityError, freshness, run_checks
from tillstream.plans.fact import refresh_fact
from tillstream.sources.readers import read_days, read_events
from tillstream.sources.schemas import AGG_SCHEMA, AGG_WITHIN, FACT_SCHEMA, RAW_SCHEMA, TIME
from tillstream.sources.settings import TopicSettings
from tillstream.streaming.jobs import SalesJob
from tillstream.streaming.progress import BatchMetrics, log_line
from tillstream.streaming.sinks import replace_batch, upsert_to


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillstream")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="messages to the raw, window and reject tables")
    stream.add_argument("--source", choices=["kafka", "parquet", "json"], default="kafka")
    stream.add_argument("--path", help="folder of a file source; its rows have one binary column, value")
    stream.add_argument("--payload", choices=["avro", "json"], default="avro")
    stream.add_argument("--raw", required=True)
    stream.add_argument("--agg", required=True)
    stream.add_argument("--upsert-agg", action="store_true", help="merge windows by key; survives a lost checkpoint")
    stream.add_argument("--rejects")
    stream.add_argument("--checkpoint", help="folder of the queries' progress; or set CHECKPOINT_DIR")
    stream.add_argument(
        "--dedup", choices=["global", "within_watermark"], default="global",
        help="global state grows for ever; in production take within_watermark, and the fact merge for what comes later",
    )
    stream.add_argument("--delay", default="10 minutes", help="how late a row may be")
    stream.add_argument("--late", help="folder for rows behind the watermark, which are dropped otherwise")
    stream.add_argument("--ahead", default=AHEAD, help="how far a row's time may be ahead of its message's arrival; rejected beyond")
    stream.add_argument("--behind", default=BEHIND, help="how far it may be behind")
    stream.add_argument("--state-partitions", type=int, help="frozen by the first start")
    stream.add_argument("--max-offsets", type=int, help="bound of a micro-batch; or KAFKA_MAX_OFFSETS_PER_TRIGGER")
    stream.add_argument("--min-partitions", type=int, help="tasks that read the topic; or KAFKA_MIN_PARTITIONS")
    stream.add_argument("--fail-on-data-loss", action="store_true", help="stop where offsets are gone from the topic")
    stream.add_argument("--trigger", help="processing time such as '30 seconds', or 'available-now'")

    fact = commands.add_parser("fact", help="merge new raw rows into the fact table")
    fact.add_argument("--raw", required=True)
    fact.add_argument("--fact", required=True)
    fact.add_argument("--lookback")
    fact.add_argument("--full-refresh", action="store_true")
    fact.add_argument("--ahead", default=AHEAD, help="rows later than now by more than this are left in the raw table")

    compact = commands.add_parser("compact", help="pack the small files of closed days")
    compact.add_argument("--raw")
    compact.add_argument("--agg")
    compact.add_argument("--fact")
    compact.add_argument("--as-of", help="days before this one are closed; default now")
    compact.add_argument("--target-mb", type=int, default=TARGET_BYTES >> 20)

    checks = commands.add_parser("checks", help="print PASS or the failing checks")
    checks.add_argument("--raw", required=True)
    checks.add_argument("--fact", help="also run the column tests of the stored fact table")
    checks.add_argument("--agg", help="also run the column tests of the stored window table")
    checks.add_argument("--as-of")
    checks.add_argument("--fail", action="store_true", help="exit with status 1 when a check fails")
    return parser


def _trigger(text: str | None) -> dict | None:
    if text is None:
        return None
    return {"availableNow": True} if text == "available-now" else {"processingTime": text}


def _stream(spark: SparkSession, args: argparse.Namespace) -> int:
    given = {"max_offsets_per_trigger": args.max_offsets, "min_partitions": args.min_partitions, "fail_on_data_loss": args.fail_on_data_loss}
    settings = replace(TopicSettings.from_env(), **{k: v for k, v in given.items() if v})
    if args.source != "kafka" and not args.path:
        raise SystemExit(f"--source {args.source} needs --path")
    checkpoint = args.checkpoint or settings.checkpoint_dir
    if not checkpoint:
        raise SystemExit("name a checkpoint: --checkpoint or CHECKPOINT_DIR")
    options = {"settings": settings} if args.source == "kafka" else {"path": args.path, "schema": "value binary", "arrival": "timestamp"}
    if args.upsert_agg:
        write_agg = upsert_to(spark, args.agg, AGG_SCHEMA, ("store_id", "window_start"), "window_start", True, AGG_WITHIN)
    else:
        write_agg = replace_batch(args.agg, "window_start")
    SalesJob(
        messages=read_events(spark, args.source, **options),
        checkpoint=checkpoint,
        write_raw=replace_batch(args.raw),
        write_agg=write_agg,
        write_rejects=replace_batch(args.rejects) if args.rejects else None,
        write_late=replace_batch(args.late) if args.late else None,
        fmt=args.payload,
        ahead=args.ahead,
        behind=args.behind,
        dedup_mode=args.dedup,
        delay=args.delay,
        partitions=args.state_partitions,
        trigger=_trigger(args.trigger),
        metrics=BatchMetrics(log=lambda row: print(log_line(row), file=sys.stderr, flush=True)),
    ).run()
    return 0


def _fact(spark: SparkSession, args: argparse.Namespace) -> int:
    raw = read_days(spark, args.raw, RAW_SCHEMA)
    refresh_fact(spark, raw, args.fact, args.lookback, args.full_refresh, ahead=args.ahead)
    return 0


def _compact(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = ((args.raw, RAW_SCHEMA, TIME, ()), (args.agg, AGG_SCHEMA, "window_start", AGG_WITHIN), (args.fact, FACT_SCHEMA, TIME, ()))
    for path, schema, time, within in tables:
        if path:
            print(path, *compact_days(spark, path, schema, args.as_of, args.target_mb << 20, time, within))
    return 0


def _checks(spark: SparkSession, args: argparse.Namespace) -> int:
    raw = read_days(spark, args.raw, RAW_SCHEMA)
    print("freshness:", *freshness(raw, args.as_of).first())
    broken = False
    for path, schema, tests in ((args.fact, FACT_SCHEMA, FACT_TESTS), (args.agg, AGG_SCHEMA, AGG_TESTS)):
        for row in run_suite(read_days(spark, path, schema), tests).collect() if path else []:
            print(*row)
            broken = broken or "FAIL" in row
    try:
        print(run_checks(raw, args.as_of, raise_on_fail=args.fail))
    except QualityError as error:
        print(error)
        return 1
    return int(broken and args.fail)


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("tillstream").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return {"stream": _stream, "fact": _fact, "compact": _compact, "checks": _checks}[args.command](spark, args)


if __name__ == "__main__":
    sys.exit(main())
