"""Starting and finishing queries. Each query has its own checkpoint, always."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tally.commits import BatchId, run_of
from tally.session import state_partitions

BatchSink = Callable[[DataFrame, int], None]


def start(
    df: DataFrame,
    checkpoint: str,
    sink: BatchSink | None = None,
    *,
    fmt: str = "parquet",
    path: str | None = None,
    mode: str = "append",
    once: bool = False,
    state_width: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start ``df`` into a per-batch callback, or else into the sink ``fmt`` at ``path``.

    The callback gets a batch id that tells the checkpoint's run too. ``once`` handles what is available and ends, otherwise a batch begins as soon as the
    last one is done. ``state_width`` bounds the number of state partitions; give it where
    the state is small, see ``state_partitions``.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if sink is not None:
        run = run_of(df.sparkSession, checkpoint)
        writer = writer.foreachBatch(lambda batch, n: sink(batch, BatchId(n, run)))
    else:
        writer = writer.format(fmt)
        if path is not None:
            writer = writer.option("path", path)
    return begin(writer, df, once=once, state_width=state_width, name=name)


def begin(
    writer: DataStreamWriter,
    df: DataFrame,
    *,
    once: bool = False,
    state_width: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    if name is not None:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    if state_width is None:
        return writer.start()
    with state_partitions(df.sparkSession, state_width):
        return writer.start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries that end by themselves; a failure in any of them is raised."""
    for query in queries:
        query.awaitTermination()
