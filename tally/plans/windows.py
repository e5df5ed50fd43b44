"""The windowed job: counts per ten-second window, and totals rolled up from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.functions import decode
from tally.operators import event_windows, processing_windows, tracked, window_rows
from tally.operators.windows import WIDTH
from tally.plans.endpoints import Documents, Endpoint
from tally.plans.reports import topics_of
from tally.schemas import BATCH_SUFFIX, ISSUES, REPORT, REPORT_ISSUE, WINDOW_TOTALS_TOPIC
from tally.streaming import fan_out, ledger_sink, start, window_ledger

# State holds the open windows only: by the clock two or three, and more by records' times.
STATE_WIDTH = 16

# Where the job keeps the ledger of its totals, below its checkpoint.
LEDGER = "window-ledger"

DELAY = "10 seconds"


def timed(log: DataFrame, labels: Sequence[str] = ISSUES) -> DataFrame:
    """Tracked reports with their own time, as ``ts``; null where it is missing or no time."""
    records = tracked(decode(log, REPORT, filtered=True), labels)
    return records.withColumn("ts", F.col("datetime").try_cast("timestamp"))


def window_counts(
    log: DataFrame, labels: Sequence[str] = ISSUES, event_time: bool = False, delay: str = DELAY
) -> DataFrame:
    """Counts per window and label: by the clock, or by the records' own times."""
    if event_time:
        return event_windows(timed(log, labels), delay=delay)
    return processing_windows(tracked(decode(log, REPORT_ISSUE, filtered=True), labels), delay=delay)


def start_windows(
    spark: SparkSession,
    source: Endpoint,
    out: Endpoint,
    checkpoint: str,
    table: Callable[[DataFrame, int], None] | None = None,
    labels: Sequence[str] = ISSUES,
    once: bool = False,
    event_time: bool = False,
    delay: str = DELAY,
    state_width: int = STATE_WIDTH,
) -> StreamingQuery:
    """One query over the batch topics, in update mode: each trigger hands the windows that it
    has changed to ``table``, and publishes the totals of all windows so far. A window's
    newest row is its count.

    Behind the watermark windows leave the state, and the totals are kept as a ledger below
    the checkpoint; so a trigger reads and writes no more than the windows that are open,
    however long the job has run. Rows later than ``delay`` count nowhere; the progress log
    tells how many.
    """
    log = source.stream(spark, topics_of(labels, BATCH_SUFFIX), checkpoint)
    record = window_ledger(f"{checkpoint}/{LEDGER}", [WIDTH, delay], labels)
    outputs = {"totals": (lambda b: b, ledger_sink(record, out.writer(WINDOW_TOTALS_TOPIC), labels))}
    if table is not None:
        outputs = {"table": (lambda b: b, table), **outputs}
    return start(
        window_rows(window_counts(log, labels, event_time, delay)),
        f"{checkpoint}/windows",
        fan_out(outputs, skip_empty=True),
        mode="update",
        once=once,
        state_width=state_width,
        name="report-windows",
    )


def start_window_table(
    spark: SparkSession,
    source: Endpoint,
    path: str,
    checkpoint: str,
    labels: Sequence[str] = ISSUES,
    delay: str = DELAY,
    once: bool = False,
    event_time: bool = False,
    state_width: int = STATE_WIDTH,
) -> StreamingQuery:
    """Each window once, when it is over, appended to a table; ``add_up`` over that table
    gives the totals. State holds the open windows only."""
    log = source.stream(spark, topics_of(labels, BATCH_SUFFIX), checkpoint)
    return start(
        window_rows(window_counts(log, labels, event_time, delay)),
        f"{checkpoint}/window-table",
        path=path,
        once=once,
        state_width=state_width,
        name="window-table",
    )


def start_untimed(
    spark: SparkSession,
    source: Endpoint,
    rejected: Documents,
    checkpoint: str,
    labels: Sequence[str] = ISSUES,
    once: bool = False,
) -> StreamingQuery:
    """The tracked reports that are in no window of their own time, with the reason. With the
    windows' counts and late rows they make up the input."""
    log = source.stream(spark, topics_of(labels, BATCH_SUFFIX), checkpoint)
    reason = F.when(F.col("datetime").isNull(), "no time").otherwise("unreadable time")
    without = timed(log, labels).filter(F.col("ts").isNull()).withColumn("reason", reason).drop("ts")
    return start(without, f"{checkpoint}/untimed", rejected.writer(), once=once, name="untimed")
