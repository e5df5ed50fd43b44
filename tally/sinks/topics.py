"""Publishing to topic logs on shared file storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tally.commits import BatchId, claim_run, commit, is_committed, open_log, run_number, run_of


def _write(log: DataFrame, path: str, number: int, batch_id: int, topic: str | None = None) -> None:
    folder, value = f"{path}/run={number}/batch_id={batch_id}", F.col("value").cast("binary")
    if topic is None:
        rows = log.select(value.alias("value"), "topic").write.partitionBy("topic")
    else:
        # A run may have writers for several topics, which are written one by one.
        folder, rows = f"{folder}/topic={topic}", log.select(value.alias("value")).write
    rows.mode("overwrite").parquet(folder)
    commit(log.sparkSession, path, folder)


def publish(log: DataFrame, path: str, even_files: bool = False) -> None:
    """Write ``value`` to the folder of each row's ``topic``; all of it counts, or none.

    Tasks write straight from their input, without a shuffle: a topic that holds much of
    the data is spread over all tasks, and a task opens one file per topic at most. From a
    very large input that makes many small files. With ``even_files`` the rows are shuffled
    by topic into pieces of the session's advisory size; large topics are cut into several
    pieces, so no task gets a whole one. Each call is a run of its own.
    """
    spark = log.sparkSession
    open_log(spark, path, write=True)
    rows = log.hint("rebalance", "topic") if even_files else log
    _write(rows, path, claim_run(spark, path, f"publish-{uuid.uuid4().hex}"), 0)


def topic_writer(path: str, topic: str | None = None) -> Callable[[DataFrame, int], None]:
    """Per-batch writer of ``value`` to the folder of each row's ``topic``, or all to one.

    A batch counts when the store's log lists it. A batch that the log lists already is not
    written again; one that an earlier attempt left unlisted is replaced. So readers get each
    batch of each run once.
    """
    done: dict[str, int] = {}

    def write(log: DataFrame, batch_id: int) -> None:
        spark, run = log.sparkSession, getattr(batch_id, "run", None)
        open_log(spark, path, write=True)
        number = run_number(spark, path, run)
        # Batches of a run come in order, so the log is asked once a start.
        if run in done:
            known = batch_id <= done[run]
        else:
            known = is_committed(spark, path, number, batch_id, topic)
        if not known:
            _write(log, path, number, int(batch_id), topic)
        if run is not None:
            done[run] = int(batch_id)

    return write


def publish_stream(log: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The same as a stream; its checkpoint is its run."""
    write, run = topic_writer(path), run_of(log.sparkSession, checkpoint)
    return (
        log.select("value", "topic")
        .writeStream.foreachBatch(lambda batch, n: write(batch, BatchId(n, run)))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
