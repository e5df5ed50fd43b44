"""Keyed output of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tally.commits import batch_folder


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one micro-batch to the folder of its run and number, replacing what an earlier
    attempt left.

    A batch may run again after a failure. It then holds the same rows, so replacing its
    folder leaves the output as if it had run once. A query with a new checkpoint is a new
    run and replaces nothing.
    """
    df.write.format(fmt).mode("overwrite").save(batch_folder(df.sparkSession, path, batch_id))
