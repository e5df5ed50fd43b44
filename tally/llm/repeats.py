"""Candidates for repeated windows: short runs, chosen by content, that occur again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import mapped

# Stands for a null doc_id in keys: the smallest id.
NO_ID = -(1 << 63)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents by (_id, _row): the row's id, and a value of its text.

    Different texts under one id thus stay apart, and rows that are equal in both are one
    document. Null ids are the smallest, null texts empty. All steps take the same three
    columns, so that Spark can read one shuffle of them again.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text).alias("_row"),
        text.alias("_text"),
    )


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least gram of each window of ``width`` grams, and which grams are the least of one."""
    least = sliding_min(grams, width)
    if not len(least):
        return least, np.zeros(0, np.int64)
    top = np.full(len(grams) + width - 1, 0, np.uint64)
    top[width - 1 : width - 1 + len(least)] = least
    # The largest of the least values of all windows that a gram lies in.
    most = ~sliding_min(~top, width)
    return least, np.flatnonzero(most[: len(grams)] == grams)


def repeated_anchors(
    base: DataFrame, find: Callable[[pa.Array], Iterator[tuple[int, np.ndarray]]]
) -> DataFrame:
    """Anchors that occur twice or more, by document: (_id, _row, hits of (hash, n)).

    ``find`` yields the row number and anchor values of the texts of a batch. Occurrences
    are added up within tasks before the shuffle. Two equal windows have the same anchors,
    so a window without a repeated anchor is not repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for row, found in find(batch.column(2)):
                value, n = np.unique(found, return_counts=True)
                rows.append(np.full(len(value), row))
                values.append(value)
                counts.append(n)
            at = pa.array(np.concatenate(rows))
            yield pa.record_batch(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(values).view(np.int64)), pa.array(np.concatenate(counts), pa.int32())],
                ["_id", "_row", "hash", "n"],
            )

    rows = mapped(base.select("_id", "_row", "_text"), run, "_id bigint, _row bigint, hash bigint, n int")
    again = rows.groupBy("hash").agg(F.sum("n").alias("total")).filter(F.col("total") > 1)
    return (
        rows.select("_id", "_row", "hash")
        .join(again, "hash")
        .groupBy("_id", "_row")
        .agg(F.collect_list(F.struct("hash", "total")).alias("hits"))
    )


def spans_array(starts: np.ndarray, length: int) -> np.ndarray:
    """Where spans of ``length`` at sorted ``starts`` begin and end, with overlaps joined."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    new = np.flatnonzero(np.diff(starts) > length)
    first = np.append(0, new + 1)
    last = np.append(new, len(starts) - 1)
    return np.stack([starts[first], starts[last] + length], axis=1)


def merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Intervals with those that overlap or touch put together, in order."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return np.stack([starts[first], reach[np.append(first[1:], len(starts)) - 1]], axis=1)


def doc_id() -> Column:
    """The id that a key stands for."""
    return F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id")


def joined(base: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents with what was gathered for them. All such joins read one shuffle of texts."""
    return base.join(lists, ["_id", "_row"], how)


def gather(rows: DataFrame, *columns: Column) -> DataFrame:
    """Rows of one document put together; their number is bounded by its length."""
    return rows.groupBy("_id", "_row").agg(F.collect_list(F.struct(*columns)).alias("found"))
