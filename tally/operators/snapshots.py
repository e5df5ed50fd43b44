"""Running totals over a history of batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.functions import block_of, quoted
from tally.operators.counts import add_up, zero_fill
from tally.schemas import ISSUES

BLOCK = 65_536


def prefix_sums(
    batches: DataFrame, columns: Sequence[str], order: str = "batch_id", block: int = BLOCK
) -> DataFrame:
    """Inclusive running sums of ``columns`` over rows in the sequence of ``order``.

    ``batches`` has one row per value of ``order``, a non-negative integer. A plain ordered
    window would put the whole history into one task, or into one per category. Here each
    block of ``block`` consecutive ids is summed on its own, the blocks' totals give each
    block its starting value, and a join on the block adds it. Only the totals meet in one
    task, one row per block: a history of ten billion batches has about 150,000 of them.

    The input is read once: both branches start from the same exchange, which Spark reuses.
    That takes equal branches, so the filter that the join implies for one of them is
    written out for both.
    """
    blocked = batches.select(
        quoted(order),
        block_of(quoted(order), block).alias("_block"),
        *[quoted(c) for c in columns],
    ).filter(F.col("_block").isNotNull())
    inside = W.partitionBy("_block").orderBy(quoted(order)).rowsBetween(W.unboundedPreceding, 0)
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = blocked.groupBy("_block").agg(*[F.sum(quoted(c)).alias(c) for c in columns])
    starts = totals.select(
        "_block",
        *[F.coalesce(F.sum(quoted(c)).over(before), F.lit(0)).alias(f"_from {c}") for c in columns],
    )
    running = blocked.select(
        quoted(order), "_block", *[F.sum(quoted(c)).over(inside).alias(c) for c in columns]
    )
    return running.join(starts, "_block").select(
        quoted(order), *[(quoted(c) + quoted(f"_from {c}")).alias(c) for c in columns]
    )


def snapshot_sums(
    snapshots: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue"
) -> DataFrame:
    """Sum each label's value over all snapshot messages, as a reader that adds up what it
    receives would. The snapshots are already cumulative, so this is no count of records.
    Runs on tables and on streams; a label that no message holds has no row.
    """
    entries = snapshots.select(F.explode("counts").alias(column, "n"))
    return add_up(entries.filter(quoted(column).isin(*labels)), column, name="n")


def accumulate(
    snapshots: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue"
) -> DataFrame:
    """``snapshot_sums`` of a table, with one row for every label."""
    return zero_fill(snapshot_sums(snapshots, labels, column), labels, column)
