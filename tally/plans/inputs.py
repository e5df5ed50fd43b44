"""The test tables seen as posts, reports and topic logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import block_of, encode, last_token
from tally.operators import report_records, route
from tally.schemas import POST_COLUMNS, REPORT_COLUMNS

# The event types that stand for tracked issues; "view" is the untracked one.
TRACKED = ("click", "error", "purchase", "signup")
UNTRACKED = "view"

# A label that no event has.
UNSEEN = "refund"

EVENTS_PER_BATCH = 1000
DOCUMENTS_PER_BATCH = 100

# Batches a finite log is replayed in.
TRIGGERS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report records of all events."""
    names = {"id": "event_id", "datetime": "ts", "issue": "event_type"}
    return report_records(table(spark, sf_dir, "events"), names)


def batched_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue and batch of every event. Batches are runs of consecutive event ids."""
    events = table(spark, sf_dir, "events")
    batch = block_of(F.col("event_id"), EVENTS_PER_BATCH).alias("batch_id")
    return events.select(batch, F.col("event_type").alias("issue"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have labels. Both tables grow, so the join is left to the optimizer."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post records of the labelled documents. The token is taken before the join, or the
    join would move whole texts between executors."""
    tokens = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), last_token(F.col("text")).alias("hashtag")
    )
    return tokens.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("toxic").cast("string").alias("sentiment"),
        "hashtag",
    )


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the column names of a delimited report file, with one column more."""
    c = REPORT_COLUMNS
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias(c["id"]),
        F.col("ts").cast("string").alias(c["datetime"]),
        F.col("event_type").alias(c["issue"]),
        F.col("props").alias("Remarks"),
    )


def post_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents under the column names of a delimited post file."""
    c = POST_COLUMNS
    return labelled(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias(c["id"]),
        F.col("toxic").cast("string").alias(c["sentiment"]),
        F.col("text").alias(c["text"]),
    )


def write_delimited(rows: DataFrame, path: str) -> None:
    """Delimited files that read back exactly, whatever the text holds."""
    rows.write.options(
        header="true",
        escape='"',
        quoteAll="true",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def as_log(reports_: DataFrame, to: str = "stream") -> DataFrame:
    return encode(route(reports_, to=to), ["id", "datetime", "issue"], ["topic"])


def report_log(spark: SparkSession, sf_dir: str, to: str = "stream") -> DataFrame:
    """All reports, tracked or not, as payloads with their topics."""
    return as_log(reports(spark, sf_dir), to)


def in_time_order(reports_: DataFrame, parts: int) -> list[DataFrame]:
    """Reports cut by their times into parts of equal length; no part is late for another."""
    ts = F.unix_micros(F.col("datetime").try_cast("timestamp"))
    first, last = reports_.agg(F.min(ts), F.max(ts)).first()
    if first is None:
        return [reports_]
    step = (last - first) // parts + 1
    part = F.floor((ts - F.lit(first)) / F.lit(step))
    return [reports_.filter(part == k) for k in range(parts)]


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of careless publishers: reports, JSON without a category, and plain text,
    with the table that each comes from. They share the topics of the tracked types."""
    reports_ = report_log(spark, sf_dir).select(
        "value",
        F.when(F.col("topic").isin(*TRACKED), F.col("topic")).otherwise("purchase").alias("topic"),
        F.lit("reports").alias("origin"),
    )
    props = table(spark, sf_dir, "events").select(
        F.col("props").cast("binary").alias("value"),
        F.lit("click").alias("topic"),
        F.lit("props").alias("origin"),
    )
    texts = table(spark, sf_dir, "documents").select(
        F.col("text").cast("binary").alias("value"),
        F.lit("error").alias("topic"),
        F.lit("texts").alias("origin"),
    )
    return reports_.unionByName(props).unionByName(texts)
