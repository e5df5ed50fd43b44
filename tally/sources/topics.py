"""Topic logs and batch outputs on shared file storage.

A topic log is parquet in folders by run, batch and topic, with a log of the files that
count. A stream reads every file that the log lists and then those that it comes to list.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.commits import bytes_below, committed_ranges, open_log, read_log, remember, started
from tally.schemas import LOG

# Where a job keeps what a topic store held at its first start.
START = "_start"

# The characters a topic name may have.
TOPIC_NAME = re.compile(r"[A-Za-z0-9._-]+")


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    fmt: str = "parquet",
    max_bytes: int | None = None,
    ignore_missing: bool = False,
    **options: str,
) -> DataFrame:
    """Files of a folder as a stream. ``max_bytes`` bounds a trigger by data volume, not by
    a number of files, so the bound holds whatever the files' sizes are. ``ignore_missing``
    goes on when a listed file has been removed before it was read."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    reader = reader.option("ignoreMissingFiles", str(ignore_missing).lower())
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path)


def topic_stream(
    spark: SparkSession,
    path: str,
    topics: Sequence[str],
    max_bytes: int | None = None,
    ignore_missing: bool = False,
) -> DataFrame:
    """The union of the named topics; files of other topics are left out by their folders.

    Only files that the store's log lists are read. The store need not be there yet, nor its
    topics: what is committed later comes later. ``max_bytes`` counts all topics' files.
    """
    for topic in topics:
        if not TOPIC_NAME.fullmatch(topic):
            raise ValueError(f"not a topic name: {topic!r}")
    open_log(spark, path)
    log = file_stream(spark, path, LOG, max_bytes=max_bytes, ignore_missing=ignore_missing)
    return log.filter(F.col("topic").isin(*topics))


def topic_table(spark: SparkSession, path: str, topics: Sequence[str]) -> DataFrame:
    """The union of the named topics as a table; the filter prunes folders."""
    return read_log(spark, path).filter(F.col("topic").isin(*topics))


def topic_batches(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The text messages of a topic, with run and batch of each."""
    rows = topic_table(spark, path, [topic])
    return rows.select(F.col("value").cast("string").alias("value"), "run", "batch_id")


def later_only(log: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Rows of a topic store that were committed after a job's first start.

    What the store held then is kept next to the job's checkpoint, as ranges of runs and how
    far each had come, so that a restart leaves out the same. A checkpoint that was begun
    without it stays without, as a start position counts for new ones only. The condition is
    on folders, so files that are left out are not read.
    """
    spark, mark = log.sparkSession, f"{checkpoint}/{START}"
    if not started(spark, checkpoint):
        remember(spark, mark, json.dumps(committed_ranges(spark, path)))
    for first, last, batch_id in json.loads(remember(spark, mark, "[]")):
        before = F.col("run").between(first, last) & (F.col("batch_id") <= batch_id)
        log = log.filter(~before)
    return log


def bytes_per_trigger(
    spark: SparkSession, path: str, triggers: int, most: int | None = None
) -> int:
    """Volume per trigger that replays a finite folder in about ``triggers`` batches, or in
    more if these would be larger than the ``most`` bytes that the caller allows.

    The file system tells the size; no file is opened.
    """
    size = bytes_below(spark, path)
    share = -(-size // triggers)
    return max(1, share if most is None else min(most, share))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Everything a keyed batch writer has left, with ``run`` and ``batch_id`` of each row."""
    return spark.read.schema(f"{schema}, run bigint, batch_id bigint").parquet(path)


def latest_batch(batches: DataFrame) -> DataFrame:
    """Rows of the newest run's highest batch id. The one-row side prunes the other batches'
    folders."""
    last = batches.agg(F.max(F.struct("run", "batch_id")).alias("last")).select("last.*")
    return batches.join(F.broadcast(last), ["run", "batch_id"], "left_semi")
