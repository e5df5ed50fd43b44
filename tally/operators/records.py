"""From source rows to records, and records to destinations. No step here shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import last_token, quoted, topic_name, with_batch_topic
from tally.schemas import ISSUES, POST_COLUMNS, REPORT_COLUMNS


def tracked(df: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue") -> DataFrame:
    """Rows whose label is exactly one of ``labels``."""
    return df.filter(quoted(column).isin(*labels))


def report_records(rows: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Report records from the three columns that carry them; the rest is not read."""
    columns = columns or REPORT_COLUMNS
    return rows.select(
        *[quoted(columns[f]).cast("string").alias(f) for f in ("id", "datetime", "issue")]
    )


def post_records(rows: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Post records; the hashtag is the last token of the text."""
    columns = columns or POST_COLUMNS
    return rows.select(
        quoted(columns["id"]).cast("string").alias("id"),
        quoted(columns["sentiment"]).cast("string").alias("sentiment"),
        last_token(quoted(columns["text"])).alias("hashtag"),
    )


def route(df: DataFrame, column: str = "issue", to: str = "both") -> DataFrame:
    """Add the destination ``topic``: the category's own, its batch twin, or both.

    ``both`` doubles the rows within the task that read them.
    """
    own = topic_name(quoted(column))
    choices = {
        "stream": own,
        "batch": with_batch_topic(own),
        "both": F.explode(F.array(own, with_batch_topic(own))),
    }
    return df.withColumn("topic", choices[to])


def wanted(labels: Sequence[str] = ISSUES, column: str = "issue") -> Column:
    """True for a tracked label, false for any other and for a missing one."""
    return F.coalesce(quoted(column).isin(*labels), F.lit(False))


def quarantine(
    checked: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue"
) -> DataFrame:
    """The payloads that cannot be counted, each with the reason why.

    ``checked`` comes from ``decode_checked``. Together with ``tracked`` this splits a log
    in two parts that miss no row. They share only payloads that go on after a tracked
    record: the record counts, and the payload is set aside for what follows it.
    """
    reason = (
        F.when(F.col("corrupt"), "undecodable")
        .when(F.col("rest"), "more than one object")
        .when(quoted(column).isNull(), "no category")
        .otherwise("unknown category")
    )
    aside = checked.filter(~wanted(labels, column) | F.col("rest"))
    return aside.withColumn("reason", reason).drop("corrupt", "rest")
