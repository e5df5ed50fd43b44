"""Reading totals topics: what a chart of the shares needs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tally.functions import decode_snapshots
from tally.operators import share_of_total, snapshot_sums, zero_fill
from tally.plans.endpoints import Endpoint
from tally.schemas import ISSUES, TOTALS_TOPIC
from tally.streaming import observed, start

Write = Callable[[DataFrame, int], None]

# How long after a message its copy may come: a writer's restart, with much to spare.
REPEATED_WITHIN = "1 day"


def share_sink(write: Write, labels: Sequence[str] = ISSUES) -> Write:
    """Per-batch callback over sums per label: all labels, each with its share."""
    return lambda sums, batch_id: write(share_of_total(zero_fill(sums, labels)), batch_id)


def once_each(messages: DataFrame, within: str = REPEATED_WITHIN) -> DataFrame:
    """Messages without the copies that a writer sends when it runs a batch again.

    A copy is known by run, batch and text. It follows soon after its first, so state is kept
    for ``within`` of the newest time of writing, and no longer.
    """
    timed = messages.withWatermark("written", within)
    return timed.dropDuplicatesWithinWatermark(["run", "batch_id", "value"])


def start_shares(
    spark: SparkSession,
    source: Endpoint,
    write: Write,
    checkpoint: str,
    topic: str = TOTALS_TOPIC,
    labels: Sequence[str] = ISSUES,
    once: bool = False,
) -> StreamingQuery:
    """Add up the snapshots of a totals topic and write each label's sum and share.

    The snapshots are cumulative, so these shares weigh early records more than late ones.
    For the shares of the records themselves use ``share_of_total`` on the newest snapshot.

    A writer that runs a batch again sends its message again; ``once_each`` drops the copy.
    """
    messages = once_each(source.outputs(spark, topic, checkpoint))
    received = decode_snapshots(messages)
    return start(
        observed(snapshot_sums(received, labels), labels),
        f"{checkpoint}/shares-{topic}",
        share_sink(write, labels),
        mode="complete",
        once=once,
        state_width=len(labels),
        name=f"shares-{topic}",
    )
