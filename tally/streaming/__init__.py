"""Streaming queries: how they are started, and the totals they keep."""

from tally.streaming.audit import state_rows, state_totals
from tally.streaming.fanout import fan_out
from tally.streaming.ledger import (
    count_ledger,
    ledger_history,
    ledger_sink,
    ledger_totals,
    window_ledger,
)
from tally.streaming.monitor import ProgressLog, wait_for_any
from tally.streaming.run import begin, finish, start
from tally.streaming.totals import (
    latest_totals,
    observed,
    running_totals,
    snapshot_sink,
    snapshots,
    to_folder,
    window_snapshot_sink,
)

__all__ = [
    "ProgressLog",
    "begin",
    "count_ledger",
    "fan_out",
    "finish",
    "latest_totals",
    "ledger_history",
    "ledger_sink",
    "ledger_totals",
    "observed",
    "running_totals",
    "snapshot_sink",
    "snapshots",
    "start",
    "state_rows",
    "state_totals",
    "to_folder",
    "wait_for_any",
    "window_ledger",
    "window_snapshot_sink",
]
