"""Counting and what is derived from counts.

Grouped counts are combined in every task before the shuffle, so a category that holds a
third of all rows sends one row per task like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.functions import quoted
from tally.schemas import ISSUES


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, as ``n``. Runs on tables and on streams."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))


def add_up(counts: DataFrame, *keys: str, n: str = "n", name: str = "total") -> DataFrame:
    """Roll partial counts up to fewer keys."""
    return counts.groupBy(*[quoted(k) for k in keys]).agg(F.sum(quoted(n)).alias(name))


def tag_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def batch_document(
    df: DataFrame,
    values: Sequence[str],
    column: str = "issue",
    batch: str = "batch_id",
    other: str | None = None,
) -> DataFrame:
    """One row per batch with one count column per value, zero where it is absent.

    ``other`` names a column for the rows that have none of the values. The result is that
    of a pivot, in one aggregation and one shuffle where a pivot takes two.
    """
    return df.groupBy(quoted(batch)).agg(*_value_counts(values, column, other))


def document(
    df: DataFrame, values: Sequence[str], column: str = "issue", other: str | None = None
) -> DataFrame:
    """``batch_document`` of a frame that is one batch: a single row."""
    return df.agg(*_value_counts(values, column, other))


def _value_counts(values: Sequence[str], column: str, other: str | None) -> list[Column]:
    label = quoted(column)
    counts = [F.count_if(label == F.lit(v)).alias(v) for v in values]
    if other is not None:
        listed = F.coalesce(label.isin(*values), F.lit(False))
        counts.append(F.count_if(~listed).alias(other))
    return counts


def label_counts(counts: DataFrame, labels: Sequence[str], column: str, n: str = "n") -> DataFrame:
    """Counts per label, added up, as a single row with one column per label, zeros included."""
    label, value = quoted(column), quoted(n)
    zero = F.lit(0).cast("bigint")
    return counts.agg(
        *[
            F.coalesce(F.sum(F.when(label == F.lit(v), value)), zero).alias(v)
            for v in labels
        ]
    )


def label_rows(
    wide: DataFrame, labels: Sequence[str], keys: Sequence[str] = (), column: str = "issue", n: str = "n"
) -> DataFrame:
    """Back from one column per label to one row per label."""
    return wide.unpivot([quoted(k) for k in keys], [quoted(v) for v in labels], column, n)


def zero_fill(
    counts: DataFrame, labels: Sequence[str] = ISSUES, column: str = "issue", n: str = "n"
) -> DataFrame:
    """Exactly one row per label, with zero for a label that was not counted.

    ``counts`` must hold one row per category at most. It is cut to ``labels`` first, so
    the broadcast side has no more rows than there are labels.
    """
    one = counts.sparkSession.range(0, 1, 1, 1)
    dimension = one.select(F.explode(F.array(*map(F.lit, labels))).alias(column))
    found = counts.filter(quoted(column).isin(*labels)).select(quoted(column), quoted(n))
    return dimension.join(F.broadcast(found), column, "left").select(
        quoted(column), F.coalesce(quoted(n), F.lit(0).cast("bigint")).alias(n)
    )


def share_of_total(counts: DataFrame, n: str = "n", digits: int = 2) -> DataFrame:
    """Percentage of the grand total. Expects one row per category: the window spans them all."""
    total = F.sum(quoted(n)).over(W.partitionBy())
    return counts.withColumn("share", F.round(F.try_divide(100 * quoted(n), total), digits))
