"""Run the jobs: ``python -m tally <job> ...``, or this file through ``spark-submit``.

A place is ``kafka://host:port`` or a folder that all executors can reach. Kafka places need
the Kafka connector on the class path.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tally.plans import posts, publisher, reports, shares, windows
from tally.plans.endpoints import Documents, Endpoint, Files, Kafka
from tally.schemas import ISSUES, TOTALS_TOPIC
from tally.session import configure
from tally.sinks import document_options, print_batch
from tally.sources import delimited_stream, delimited_table
from tally.streaming import ProgressLog, finish, to_folder, wait_for_any

KAFKA = "kafka://"


def endpoint(place: str, args: argparse.Namespace) -> Endpoint:
    if place.startswith(KAFKA):
        return Kafka(
            place.removeprefix(KAFKA),
            start=args.start,
            fail_on_data_loss=not args.tolerate_data_loss,
            max_offsets=args.max_offsets,
            min_partitions=args.min_partitions,
        )
    return Files(
        place,
        max_bytes=args.max_bytes,
        ignore_missing=args.tolerate_data_loss,
        start=args.start,
    )


def document_target(place: str, collection: str) -> Documents:
    if place.startswith("mongodb"):
        uri, _, database = place.rpartition("/")
        return Documents(options=document_options(uri, database, collection))
    return Documents(path=f"{place}/{collection}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tally", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--labels", nargs="+", default=list(ISSUES))
        sub.add_argument("--start", choices=("earliest", "latest"), default="earliest")
        sub.add_argument("--tolerate-data-loss", action="store_true")
        sub.add_argument("--max-bytes", type=int, help="most bytes of files a trigger takes")
        sub.add_argument("--max-offsets", type=int, help="most Kafka records a trigger takes")
        sub.add_argument("--min-partitions", type=int, help="least tasks a Kafka trigger makes")
        sub.add_argument("--checkpoint", help="folder for the state of this job")
        sub.add_argument("--once", action="store_true", help="end when all input is read")
        return sub

    for name in ("publish-reports", "publish-posts"):
        sub = job(name, "delimited files to topics")
        sub.add_argument("input", help="delimited file or folder, with a header line")
        sub.add_argument("out", help="place of the topics")
        sub.add_argument(
            "--single-line", action="store_true", help="no field holds a line break; files are not looked through for that"
        )
        if name == "publish-reports":
            sub.add_argument("--to", choices=("stream", "batch", "both"), default="both")
            sub.add_argument("--follow", action="store_true", help="go on as files arrive")

    sub = job("reports", "records, republished records and running totals")
    sub.add_argument("source", help="place of the topics to read")
    sub.add_argument("out", help="place of the topics to write")
    sub.add_argument("documents", help="folder, or mongodb://host/database")

    sub = job("windows", "counts per ten-second window, and totals from them")
    sub.add_argument("source")
    sub.add_argument("out")
    sub.add_argument("--table", required=True, help="folder for the windows each trigger changes")
    sub.add_argument("--event-time", action="store_true", help="window by the records' own times")
    sub.add_argument("--delay", default=windows.DELAY, help="how late a row may come")
    sub.add_argument("--rejected", help="folder for reports without a readable time")

    sub = job("window-table", "each ten-second window once, when it is over")
    sub.add_argument("source")
    sub.add_argument("table", help="folder for the windows")
    sub.add_argument("--event-time", action="store_true", help="window by the records' own times")
    sub.add_argument("--delay", default=windows.DELAY, help="how late a row may come")

    sub = job("shares", "sums and shares from a totals topic")
    sub.add_argument("source", help="place of the totals topic")
    sub.add_argument("--topic", default=TOTALS_TOPIC)
    sub.add_argument("--table", help="folder for the shares; printed if not given")

    sub = job("posts", "counts per sentiment of each batch, and polarity totals")
    sub.add_argument("source")
    sub.add_argument("documents", help="folder, or mongodb://host/database")
    sub.add_argument("--totals", help="folder for the totals; printed if not given")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    queries = []
    if args.job.startswith("publish"):
        out = endpoint(args.out, args)
        breaks = False if args.single_line else None
        if args.job == "publish-posts":
            publisher.publish_posts(delimited_table(spark, args.input, multiline=breaks), out)
        elif args.follow:
            rows = delimited_stream(
                spark, args.input, multiline=not args.single_line, max_bytes=args.max_bytes
            )
            queries = [
                publisher.publish_reports_stream(
                    rows, out, args.checkpoint, args.labels, args.to, args.once
                )
            ]
        else:
            rows = delimited_table(spark, args.input, multiline=breaks)
            publisher.publish_reports(rows, out, args.labels, args.to)
    elif args.job == "reports":
        queries = reports.start_reports(
            spark,
            endpoint(args.source, args),
            endpoint(args.out, args),
            document_target(args.documents, "records"),
            document_target(args.documents, "rejected"),
            args.checkpoint,
            args.labels,
            args.once,
        )
    elif args.job == "windows":
        source = endpoint(args.source, args)
        queries = [
            windows.start_windows(
                spark,
                source,
                endpoint(args.out, args),
                args.checkpoint,
                to_folder(args.table),
                args.labels,
                args.once,
                args.event_time,
                args.delay,
            )
        ]
        if args.rejected:
            rejected = Documents(path=args.rejected)
            queries.append(
                windows.start_untimed(
                    spark, source, rejected, args.checkpoint, args.labels, args.once
                )
            )
    elif args.job == "window-table":
        queries = [
            windows.start_window_table(
                spark,
                endpoint(args.source, args),
                args.table,
                args.checkpoint,
                args.labels,
                args.delay,
                args.once,
                args.event_time,
            )
        ]
    elif args.job == "shares":
        queries = [
            shares.start_shares(
                spark,
                endpoint(args.source, args),
                to_folder(args.table) if args.table else print_batch,
                args.checkpoint,
                args.topic,
                args.labels,
                args.once,
            )
        ]
    else:
        queries = posts.start_posts(
            spark,
            endpoint(args.source, args),
            document_target(args.documents, "batches"),
            to_folder(args.totals) if args.totals else print_batch,
            args.checkpoint,
            once=args.once,
        )
    if args.once:
        finish(*queries)
    elif queries:
        wait_for_any(spark)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    streams = not args.job.startswith("publish") or getattr(args, "follow", False)
    if streams and not args.checkpoint:
        raise SystemExit("a streaming job needs --checkpoint")
    logging.basicConfig(level=logging.INFO)
    spark = configure(SparkSession.builder.appName(f"tally-{args.job}")).getOrCreate()
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        run(spark, args)
    finally:
        spark.streams.removeListener(listener)
        spark.stop()


if __name__ == "__main__":
    main()
