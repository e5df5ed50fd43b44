"""Publish the rows of delimited files to topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.functions import encode
from tally.operators import post_records, report_records, route, tracked
from tally.plans.endpoints import Endpoint
from tally.schemas import ISSUES, POST_TOPIC
from tally.streaming import begin

REPORT_FIELDS = ("id", "datetime", "issue")
POST_FIELDS = ("id", "sentiment", "hashtag")


def report_log(rows: DataFrame, labels: Sequence[str] = ISSUES, to: str = "both") -> DataFrame:
    """Tracked rows as payloads with their destination topics."""
    records = route(tracked(report_records(rows), labels), to=to)
    return encode(records, REPORT_FIELDS, keep=["topic"])


def post_log(rows: DataFrame) -> DataFrame:
    """All rows as payloads for the one topic of posts."""
    records = post_records(rows).withColumn("topic", F.lit(POST_TOPIC))
    return encode(records, POST_FIELDS, keep=["topic"])


def publish_reports(
    rows: DataFrame, out: Endpoint, labels: Sequence[str] = ISSUES, to: str = "both"
) -> None:
    out.publish(report_log(rows, labels, to))


def publish_posts(rows: DataFrame, out: Endpoint) -> None:
    out.publish(post_log(rows))


def publish_reports_stream(
    rows: DataFrame,
    out: Endpoint,
    checkpoint: str,
    labels: Sequence[str] = ISSUES,
    to: str = "both",
    once: bool = False,
) -> StreamingQuery:
    """The same for files that keep arriving."""
    writer = out.publish_stream(report_log(rows, labels, to), checkpoint)
    return begin(writer, rows, once=once, name="publish-reports")
