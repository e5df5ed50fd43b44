"""What a running query reports."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("tally")


class ProgressLog(StreamingQueryListener):
    """Log a line per batch, with the totals that a query reports and the rows that came too
    late for their windows. Register with ``spark.streams.addListener``."""

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = sum(s.numRowsTotal for s in p.stateOperators)
        log.info(
            "%s batch %d: %d rows, %.0f rows/s, %d state rows",
            p.name or p.id, p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0, state,
        )
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        if late:
            log.warning("%s batch %d: %d rows too late", p.name or p.id, p.batchId, late)
        for name, values in (p.observedMetrics or {}).items():
            log.info("%s batch %d: %s %s", p.name or p.id, p.batchId, name, values.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("ended %s: %s", event.id, event.exception)
        else:
            log.info("ended %s", event.id)


def wait_for_any(spark: SparkSession) -> None:
    """Block until any query of the session ends, and raise if it failed. A driver that
    waited for one certain query would not notice when another one dies."""
    spark.streams.awaitAnyTermination()
