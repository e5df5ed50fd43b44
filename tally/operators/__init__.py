"""DataFrame operators: routing, counts, snapshots, windows."""

from tally.operators.counts import (
    add_up,
    batch_document,
    count_by,
    document,
    label_counts,
    label_rows,
    share_of_total,
    tag_batch,
    zero_fill,
)
from tally.operators.records import (
    post_records,
    quarantine,
    report_records,
    route,
    tracked,
    wanted,
)
from tally.operators.snapshots import accumulate, prefix_sums, snapshot_sums
from tally.operators.windows import event_windows, processing_windows, window_rows

__all__ = [
    "accumulate",
    "add_up",
    "batch_document",
    "count_by",
    "document",
    "event_windows",
    "label_counts",
    "label_rows",
    "post_records",
    "prefix_sums",
    "processing_windows",
    "quarantine",
    "report_records",
    "route",
    "share_of_total",
    "snapshot_sums",
    "tag_batch",
    "tracked",
    "wanted",
    "window_rows",
    "zero_fill",
]
