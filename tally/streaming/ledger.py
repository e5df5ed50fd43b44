"""Totals kept as a ledger: an entry a batch, made from the entry before it.

An entry is written by the batch that it counts, next to the batch's other outputs, and is
known by run and batch like them. A batch that runs again makes the same entry again, from
the same entry before it. So whatever a failure interrupts, totals and records are those of
the same batches once the batch has ended. Only one entry is read for the next, however long
the history is, and no state store takes part.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.commits import batch_before, batch_folder
from tally.functions import quoted
from tally.operators import prefix_sums, zero_fill
from tally.schemas import ISSUES
from tally.sinks import write_batch
from tally.sources import latest_batch, read_batches
from tally.streaming.totals import Write, snapshots

log = logging.getLogger("tally")

Record = Callable[[DataFrame, int], DataFrame]


def entry_schema(column: str = "issue") -> str:
    return f"`{column}` string, n bigint, total bigint"


def _write(rows: DataFrame, path: str, batch_id: int, schema: str) -> DataFrame:
    """Write an entry, which is small, as one file, and read it back."""
    write_batch(rows.coalesce(1), path, batch_id)
    spark = rows.sparkSession
    return spark.read.schema(schema).parquet(batch_folder(spark, path, batch_id))


def _before(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    folder = batch_before(spark, path, batch_id)
    return spark.createDataFrame([], schema) if folder is None else spark.read.schema(schema).parquet(folder)


def count_ledger(path: str, labels: Sequence[str] = ISSUES, column: str = "issue") -> Record:
    """Enter a batch's counts per label; gives the entry: label, ``n`` of the batch and
    ``total`` up to it, one row for every label."""
    schema = entry_schema(column)

    def record(counts: DataFrame, batch_id: int) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        now = zero_fill(counts, labels, column).select(quoted(column), "n", F.col("n").alias("total"))
        earlier = _before(counts.sparkSession, path, batch_id, schema)
        old = earlier.select(quoted(column), zero.alias("n"), "total")
        entry = now.unionByName(old).groupBy(quoted(column)).agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")
        )
        return _write(entry, path, batch_id, schema)

    return record


WINDOW = "window_start timestamp, window_end timestamp"


def window_ledger(
    path: str, keep: Sequence[str], labels: Sequence[str] = ISSUES, column: str = "issue"
) -> Record:
    """The same from windows whose counts a batch has changed (update mode), as
    ``window_rows``.

    A changed window adds what it has gained since its last count. Those counts are kept for
    windows that may still change: all that ended at most ``keep`` (the windows' width, the
    watermark's delay) before the newest of the entry before, as late rows are told by
    the watermark of the batch before.
    """
    totals = count_ledger(f"{path}/totals", labels, column)
    schema = f"{WINDOW}, `{column}` string, n bigint"
    names = ["window_start", "window_end", column]

    def record(windows: DataFrame, batch_id: int) -> DataFrame:
        spark = windows.sparkSession
        now = windows.filter(quoted(column).isin(*labels)).select(*map(quoted, [*names, "n"]))
        earlier = _before(spark, f"{path}/open", batch_id, schema)
        merged = (
            now.withColumnRenamed("n", "new")
            .unionByName(earlier.withColumnRenamed("n", "old"), allowMissingColumns=True)
            .groupBy(*map(quoted, names))
            .agg(F.max("new").alias("new"), F.max("old").alias("old"))
        )
        gain = F.col("new") - F.coalesce("old", F.lit(0))
        gained = merged.filter("new is not null").groupBy(quoted(column)).agg(F.sum(gain).alias("n"))
        oldest = F.max("window_end")
        for span in keep:
            oldest = oldest - F.expr(f"interval {span}")
        oldest = earlier.agg(F.unix_micros(oldest)).first()[0]
        alive = F.lit(True) if oldest is None else F.unix_micros("window_end") > oldest
        still = merged.filter(alive).select(*map(quoted, names), F.coalesce("new", "old").alias("n"))
        _write(still, f"{path}/open", batch_id, schema)
        return totals(gained, batch_id)

    return record


def ledger_sink(record: Record, publish: Write, labels: Sequence[str] = ISSUES, column: str = "issue") -> Write:
    """Per-batch callback that enters a batch, logs the totals and publishes their snapshot."""

    def write(counts: DataFrame, batch_id: int) -> None:
        entry = record(counts, batch_id).select(quoted(column), F.col("total").alias("n"))
        found = {r[column]: r["n"] for r in entry.collect()}  # one row for each label
        log.info("totals after batch %d: %s", batch_id, {label: found[label] for label in labels})
        publish(snapshots(entry, labels, column), batch_id)

    return write


def ledger_totals(spark: SparkSession, path: str, column: str = "issue") -> DataFrame:
    """The newest entry's totals, one row per label."""
    entries = read_batches(spark, path, entry_schema(column))
    return latest_batch(entries).select(quoted(column), F.col("total").alias("n"))


def ledger_history(
    spark: SparkSession, path: str, labels: Sequence[str] = ISSUES, column: str = "issue", run: int = 1
) -> DataFrame:
    """Totals after every batch of a run, one column per label, from the batches' own counts."""
    entries = read_batches(spark, path, entry_schema(column)).filter(F.col("run") == run)
    wide = entries.groupBy("batch_id").agg(
        *[F.sum(F.when(quoted(column) == F.lit(v), F.col("n"))).alias(v) for v in labels]
    )
    return prefix_sums(wide, labels)
