"""Where long jobs cut their lineage, and how Python steps reach the executors."""

from __future__ import annotations

import gc
import shutil
import tempfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame

from tally.session import scratch

ROWS = 2048

PACKAGE = Path(__file__).resolve().parents[1]

_shipped: dict[str, str] = {}


def cut(frame: DataFrame) -> DataFrame:
    """``frame`` written to the checkpoint folder and read back from there.

    The folder is the one that the cluster names in ``spark.checkpoint.dir``, so a lost
    executor loses nothing of it. A session that names none gets a scratch folder, which
    outside local mode is refused.

    Once the table is written, shuffle files that led to it and that nothing else refers to
    are garbage. They can be as large as the input, so they are not left to wait until the
    driver happens to collect its garbage.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch(spark, "checkpoints"))
    written = frame.checkpoint()
    del frame
    gc.collect()
    context._jvm.System.gc()
    return written


def table(frame: DataFrame) -> DataFrame:
    """As ``cut``, but as a compressed Parquet table, a fraction of the size where rows are
    many and narrow. The caller gives it back with ``discard`` when nothing reads it any more.
    """
    spark = frame.sparkSession
    folder = scratch(spark, "table")
    frame.write.option("compression", "zstd").parquet(folder)
    written = spark.read.schema(frame.schema).parquet(folder)
    written._folder = folder
    del frame
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return written


def discard(*tables: DataFrame) -> None:
    """Delete what ``table`` has written; a table that has been taken over by a later one is
    only in the way."""
    for written in tables:
        spark = written.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(written._folder)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def ship(context: SparkContext) -> None:
    """Send this package's code to the executors, once a session. Spark's own file server
    hands it out; no task reads the archive's place on the driver."""
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="package-")
        archive = shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name)
        context.addPyFile(archive)
        _shipped[context.applicationId] = archive


def mapped(frame: DataFrame, function, schema) -> DataFrame:
    """``frame.mapInArrow`` with this package's code at hand on the executors.

    Batches are handed on in pieces of ``ROWS`` rows, which bounds what a step holds besides
    its batch.
    """

    def pieces(batches):
        return function(b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS))

    ship(frame.sparkSession.sparkContext)
    return frame.mapInArrow(pieces, schema)
