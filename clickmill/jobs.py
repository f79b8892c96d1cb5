"""Command-line entry for spark-submit.

    spark-submit clickmill/jobs.py hour 2024-01-01 10 --lake s3a://bucket/lake --hot s3a://bucket/hot
    spark-submit clickmill/jobs.py mart 2024-01-01 10 --name rfm_segments --lake ... --hot ...
    spark-submit clickmill/jobs.py backfill 2024-01-01 2024-01-31 --lake ... --hot ...
    spark-submit clickmill/jobs.py pending 2024-01-02 00 --lake ... --hot ...      all hot hours before that one
    spark-submit clickmill/jobs.py compact --lake ... --hot ...                    merges the hot batches of each hour
    spark-submit clickmill/jobs.py register --lake ... --hot ... --catalog shop_   makes the lake's tables known
    spark-submit clickmill/jobs.py ingest --lake ... --hot ... --servers host:9092 --topic events --checkpoint ...

With ``--catalog`` (a prefix, which may be empty) new partitions are published to the registered tables.

Prints the rows of each step as one JSON line. Time without data is not an error; every failure is.
"""

from __future__ import annotations

import argparse
import json
import sys

from clickmill.plans import hourly
from clickmill.session import build_session
from clickmill.sources.catalog import register_lake
from clickmill.sources.topics import read_topic
from clickmill.streaming.ingest import start_ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickmill")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, second in (("hour", "hour"), ("mart", "hour"), ("backfill", "last"), ("pending", "hour"), ("compact", None),
                         ("register", None), ("ingest", None)):
        command = commands.add_parser(name)
        if second:
            command.add_argument("date")
            command.add_argument(second)
        command.add_argument("--lake", required=True)
        command.add_argument("--hot", required=True)
        command.add_argument("--catalog")
        if name == "ingest":
            for option in ("--servers", "--topic", "--checkpoint"):
                command.add_argument(option, required=True)
            command.add_argument("--quarantine", help="folder of rejected messages, by default beside the hot tier")
            command.add_argument("--every", help="trigger interval, such as '1 minute'; without it the job ends with the topic")
        if name == "mart":
            command.add_argument("--name", required=True, choices=list(hourly.MARTS))
    return parser


def _ingest(spark, lake: hourly.Lake, args: argparse.Namespace) -> dict[str, int | None]:
    messages = read_topic(spark, args.servers, args.topic)
    rejected = args.quarantine or f"{lake.hot.rstrip('/')}-quarantine"
    query = start_ingest(messages, lake.hot, rejected, args.checkpoint, every=args.every)
    query.awaitTermination()  # raises what ended the stream
    last = query.lastProgress
    return {"last_batch": last["batchId"] if last else None}


def main(arguments: list[str] | None = None) -> int:
    args = _parser().parse_args(arguments)
    spark = build_session("-".join(["clickmill", args.command, *filter(None, [getattr(args, "date", None)])]))
    lake = hourly.Lake(args.lake, args.hot, args.catalog)
    try:
        if args.command == "hour":
            rows = hourly.run_hour(spark, lake, args.date, args.hour)
        elif args.command == "mart":
            rows = {args.name: hourly.build_mart(spark, lake, args.name, args.date, args.hour)}
        elif args.command == "backfill":
            rows = hourly.backfill(spark, lake, args.date, args.last)
        elif args.command == "pending":
            rows = {"hours": [" ".join(hour) for hour in hourly.run_pending(spark, lake, f"{args.date} {args.hour}")]}
        elif args.command == "compact":
            rows = {"merged": hourly.compact_hot(spark, lake.hot)}
        elif args.command == "register":
            rows = {"tables": register_lake(spark, lake.root, args.catalog or "")}
        else:
            rows = _ingest(spark, lake, args)
        print(json.dumps(rows))
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
