"""One query, several outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tally.session import setting

Shape = Callable[[DataFrame], DataFrame]
Write = Callable[[DataFrame, int], None]

CACHE_COMPRESSION = "spark.sql.inMemoryColumnarStorage.compressed"


@contextmanager
def kept(batch: DataFrame) -> Iterator[DataFrame]:
    """Hold a batch on the executors, on disk where memory is short, for the length of a
    block. A lost part is computed again from the source.

    It is held as it is: for a batch that is read two or three times, compressing the
    columns costs more than parsing the payloads once more would.
    """
    with setting(batch.sparkSession, CACHE_COMPRESSION, "false"):
        held = batch.persist()
        try:
            yield held
        finally:
            held.unpersist()


def fan_out(outputs: dict[str, tuple[Shape, Write]], skip_empty: bool = False) -> Write:
    """A per-batch callback that reads and decodes a batch once and writes every output.

    Streaming queries do not share a scan, so separate queries would each read the source
    again. With ``skip_empty`` a batch without rows writes nothing; a query with a watermark
    has such batches whenever the watermark moves.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as held:
            if skip_empty and held.isEmpty():
                return
            for shape, sink in outputs.values():
                sink(shape(held), batch_id)

    return write
