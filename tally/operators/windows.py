"""Counts per tumbling window and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions import quoted

WIDTH = "10 seconds"


def processing_windows(
    df: DataFrame, column: str = "issue", width: str = WIDTH, delay: str | None = None
) -> DataFrame:
    """Window by the time of processing: all rows of a micro-batch share one window.

    Nothing is ever late by this clock, so a short ``delay`` bounds the state and loses no
    row; without one a stream keeps every window it has seen.
    """
    timed = df.withColumn("_now", F.current_timestamp())
    return event_windows(timed, "_now", column, width, delay)


def event_windows(
    df: DataFrame,
    time: str = "ts",
    column: str = "issue",
    width: str = WIDTH,
    delay: str | None = None,
) -> DataFrame:
    """Window by the record's own time, which gives the same result at every run.

    With a ``delay`` a stream forgets windows that are older, which bounds its state; rows
    later than that are not counted, and in append mode a window is emitted only once the
    watermark has passed it. Watermarks need a zoned timestamp, so one without a zone is
    read in the session's zone.
    """
    if delay is not None:
        df = df.withColumn(time, quoted(time).cast("timestamp")).withWatermark(time, delay)
    keys = [F.window(quoted(time), width), quoted(column)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def window_rows(counts: DataFrame, column: str = "issue") -> DataFrame:
    """The window struct as two plain columns."""
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        quoted(column),
        "n",
    )
