"""Printing, for debugging and for small tables such as totals."""

from __future__ import annotations

from pyspark.sql import DataFrame

ALL_ROWS = 2**31 - 1


def print_batch(
    df: DataFrame, batch_id: int, rows: int = ALL_ROWS, truncate: bool = False
) -> None:
    """Per-batch form, to be used as one output among others.

    All rows are printed in full unless ``rows`` or ``truncate`` ask for less. The driver
    holds what is printed, so give ``rows`` for anything but a small table.
    """
    print(f"batch {batch_id}")
    df.write.format("console").mode("append").option("numRows", rows).option(
        "truncate", str(truncate).lower()
    ).save()
