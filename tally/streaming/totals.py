"""Totals that live in the state store, and the snapshots published from them.

All totals run in complete mode, so that every snapshot holds all categories; update mode
would give changed categories only. Their state has one row per category.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions import decode_snapshots, quoted, snapshot_json
from tally.operators import count_by, label_counts, tracked, window_rows
from tally.schemas import ISSUES
from tally.sinks import write_batch
from tally.streaming.fanout import kept

Write = Callable[[DataFrame, int], None]


def running_totals(
    records: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue"
) -> DataFrame:
    """Records per tracked category since the checkpoint began."""
    return count_by(tracked(records, labels, column), column)


def observed(
    totals: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue", n: str = "n"
) -> DataFrame:
    """The totals, with each label's value reported in the query's progress, as ``totals``."""
    label, value = quoted(column), quoted(n)
    values = [F.coalesce(F.sum(F.when(label == F.lit(v), value)), F.lit(0)).alias(v) for v in labels]
    return totals.observe("totals", *values)


def snapshots(
    totals: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue", n: str = "n"
) -> DataFrame:
    """One message: a JSON object with every label's count, zeros included."""
    return label_counts(totals, labels, column, n).select(snapshot_json(labels).alias("value"))


def to_folder(path: str) -> Write:
    return lambda df, batch_id: write_batch(df, path, batch_id)


def snapshot_sink(
    write: Write, labels: Sequence[str] = ISSUES, column: str = "issue"
) -> Write:
    """Per-batch callback that publishes the totals after each batch."""
    return lambda totals, batch_id: write(snapshots(totals, labels, column), batch_id)


def window_snapshot_sink(
    table: Write | None, totals: Write, labels: Sequence[str] = ISSUES, column: str = "issue"
) -> Write:
    """Per-batch callback over complete window counts: the window table and the totals per
    category, both from one query and so over the same windows.
    """

    def write(counts: DataFrame, batch_id: int) -> None:
        if table is None:
            totals(snapshots(counts, labels, column), batch_id)
            return
        with kept(counts) as held:
            table(window_rows(held, column), batch_id)
            totals(snapshots(held, labels, column), batch_id)

    return write


def latest_totals(history: DataFrame, column: str = "issue") -> DataFrame:
    """The newest snapshot of a history of ``value``, ``run`` and ``batch_id``, one row per
    label."""
    newest = history.agg(F.max_by("value", F.struct("run", "batch_id")).alias("value"))
    return decode_snapshots(newest).select(F.explode("counts").alias(column, "n"))
