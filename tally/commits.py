"""What has been written: runs of queries, their batches, and the log of a topic store.

A batch is known by its run and its number. A run is a checkpoint: a query that goes on from
one goes on with its run, and one with a new checkpoint is a new run, whose batches begin at
0 again. Next to each output a small registry numbers the runs in the order of their first
batch there, so that (run, batch) orders what the output holds.

A topic store lists its files in the log that Spark's own file sink keeps. Spark's readers,
of tables and of streams, read what that log lists and no other file; so what a failed
attempt has left does not count, and a batch counts when its entry is there, all at once.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.schemas import LOG

RUN_FILE = "_run"
RUNS = "_runs"
SINK_LOG = "_spark_metadata"

# Fixed value: the version that the log's entries have.
LOG_VERSION = 1

# Run number of what is written without a query.
NO_RUN = 0


# How many batch numbers are tried before folders are listed.
NEAR = 8


class BatchId(int):
    """The number of a batch, and the run that it belongs to."""

    run: str | None

    def __new__(cls, number: int, run: str | None = None) -> BatchId:
        self = super().__new__(cls, number)
        self.run = run
        return self

    @property
    def key(self) -> str:
        """Run and number as text, for stores that know a batch by one key."""
        return f"{self.run}/{int(self)}" if self.run else str(int(self))


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _read(spark: SparkSession, path: str) -> str | None:
    files, at = _place(spark, path)
    if not files.exists(at):
        return None
    lines = spark._jvm.org.apache.commons.io.IOUtils
    stream = files.open(at)
    try:
        return lines.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there already; of several writers one succeeds."""
    files, at = _place(spark, path)
    try:
        stream = files.create(at, False)
    except Exception:
        if files.exists(at):
            return False
        raise
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return True


def remember(spark: SparkSession, path: str, text: str) -> str:
    """The content of a small file, which is ``text`` if it was not there before."""
    known = _read(spark, path)
    if known is None:
        _create(spark, path, text)
        known = _read(spark, path)
    return known


def started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether anything has been kept at a checkpoint."""
    files, at = _place(spark, checkpoint)
    return files.exists(at) and len(files.listStatus(at)) > 0


def bytes_below(spark: SparkSession, path: str) -> int:
    files, at = _place(spark, path)
    return files.getContentSummary(at).getLength()


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run that a checkpoint stands for; it is named at its first use. Names begin with
    the time, for stores that can only order them as text."""
    name = f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:12]}"
    return remember(spark, f"{checkpoint}/{RUN_FILE}", name)


def claim_run(spark: SparkSession, path: str, run: str) -> int:
    """A number of the registry at ``path`` that no other run has, larger than all before."""
    files, at = _place(spark, f"{path}/{RUNS}")
    files.mkdirs(at)
    names = [f.getPath().getName() for f in files.listStatus(at)]
    number = max((int(n) for n in names if n.isdigit()), default=NO_RUN) + 1
    while not _create(spark, f"{path}/{RUNS}/{number:09d}", run):
        number += 1
    return number


def run_number(spark: SparkSession, path: str, run: str | None) -> int:
    """The number of a run at an output, claimed with its first batch there."""
    if run is None:
        return NO_RUN
    name = f"{path}/{RUNS}/run-{run}"
    known = _read(spark, name)
    return int(known if known is not None else remember(spark, name, str(claim_run(spark, path, run))))


def batch_folder(spark: SparkSession, path: str, batch_id: int) -> str:
    """The folder of a batch, which a repeat of the batch replaces."""
    number = run_number(spark, path, getattr(batch_id, "run", None))
    return f"{path}/run={number}/batch_id={int(batch_id)}"


def batch_before(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """The folder of the batch of the same run that came last before this one. That is one
    of the numbers just before, unless the output was begun late; only then are folders
    listed."""
    own = f"{path}/run={run_number(spark, path, getattr(batch_id, 'run', None))}"
    files, at = _place(spark, own)
    for number in range(int(batch_id) - 1, max(int(batch_id) - NEAR, 0) - 1, -1):
        if files.exists(_place(spark, f"{own}/batch_id={number}")[1]):
            return f"{own}/batch_id={number}"
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    ids = [int(n.partition("=")[2]) for n in names if n.startswith("batch_id=")]
    last = max((i for i in ids if i < batch_id), default=None)
    return None if last is None else f"{own}/batch_id={last}"


# ---- the log of a topic store


def open_log(spark: SparkSession, path: str, write: bool = False) -> None:
    """Begin an empty topic store where there is none, so that it can be read before the
    first topic is written. A folder of files without a log can be read as it is, but not
    written to: a log would hide what it holds."""
    files, at = _place(spark, path)
    log = _place(spark, f"{path}/{SINK_LOG}")[1]
    if files.exists(log):
        return
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    if all(n.startswith(("_", ".")) for n in names):
        files.mkdirs(log)
    elif write:
        raise ValueError(f"{path} holds files without a log")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All that a topic store's log lists, with run and batch of each row."""
    open_log(spark, path)
    return spark.read.schema(LOG).parquet(path)


def is_committed(
    spark: SparkSession, path: str, number: int, batch_id: int, topic: str | None = None
) -> bool:
    """Whether the log lists a batch, or its part of one topic. The condition is on folders,
    so only their files are read."""
    own = (F.col("run") == number) & (F.col("batch_id") == int(batch_id))
    if topic is not None:
        own &= F.col("topic") == topic
    return not read_log(spark, path).filter(own).isEmpty()


def commit(spark: SparkSession, path: str, folder: str) -> None:
    """Add the files below ``folder`` to the log, in one entry."""
    sinks = spark._jvm.org.apache.spark.sql.execution.streaming.sinks
    files, at = _place(spark, folder)
    found, listed = files.listFiles(at, True), []
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().startswith("part-"):
            listed.append(sinks.SinkFileStatus.apply(status))
    if not listed:
        return
    entries = spark.sparkContext._gateway.new_array(sinks.SinkFileStatus, len(listed))
    for i, status in enumerate(listed):
        entries[i] = status
    none = getattr(getattr(spark._jvm.scala, "None$"), "MODULE$")

    def next_entry() -> tuple:
        log = sinks.FileStreamSinkLog(LOG_VERSION, spark._jsparkSession, f"{path}/{SINK_LOG}", none)
        latest = log.getLatestBatchId()
        return log, latest.get() + 1 if latest.isDefined() else 0

    # Of several writers that add an entry of the same number, one succeeds; the others find
    # it taken and try the next.
    while True:
        log, number = next_entry()
        try:
            if log.add(number, entries):
                return
        except Exception:
            if next_entry()[1] <= number:
                raise


def committed_ranges(spark: SparkSession, path: str) -> list[list[int]]:
    """What the log lists, as [first run, last run, last batch]: runs that follow each other
    and have come equally far are one entry. The driver gets a row a run."""
    far = read_log(spark, path).groupBy("run").agg(F.max("batch_id").alias("last"))
    out: list[list[int]] = []
    for run, last in sorted(map(tuple, far.collect())):
        if out and out[-1][1] == run - 1 and out[-1][2] == last:
            out[-1][1] = run
        else:
            out.append([run, run, last])
    return out
