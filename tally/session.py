"""Session settings, scratch folders and the state sizing used by streams."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings every job here relies on; sizes stay with the cluster's own defaults."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A topic write opens one file per topic in each task. With this many writers
        # allowed at once the task does not have to sort its rows by topic first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        # Window state grows with time, so it lives off the heap and its checkpoints
        # are change logs instead of full snapshots.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    )


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder on storage that every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local-mode session
    may do without it, because there all tasks share one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors"
            )
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tally/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def state_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """Start a stateful query with at most ``most`` state partitions.

    A query copies the session's settings when it starts and keeps its shuffle width for
    the life of its checkpoint. A total over a handful of categories has no use for the
    hundreds of state stores a wide default would make it commit at every trigger: rows
    are combined before the shuffle, so each task sends one row per category.
    """
    width = max(1, min(most, int(spark.conf.get(SHUFFLE_PARTITIONS))))
    with setting(spark, SHUFFLE_PARTITIONS, str(width)):
        yield
