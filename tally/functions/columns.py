"""Scalar expressions. Everything here is a built-in and stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tally.schemas import BATCH_SUFFIX, POLARITIES, POSITIVE_CODE


def quoted(name: str) -> Column:
    """Column whose name may hold spaces or dots."""
    escaped = name.replace("`", "``")
    return F.col(f"`{escaped}`")


def block_of(number: Column, width: int) -> Column:
    """Which run of ``width`` consecutive integers a number is in. Integer division: the
    ``/`` operator would go through doubles and lose large ids."""
    return F.call_function("div", number, F.lit(width))


def last_token(text: Column) -> Column:
    """What follows the last space; the whole text if it has none.

    Only the space separates, so a token may hold line breaks, and a trailing space gives
    an empty token. ``substring_index`` finds it from the right without building an array
    of all the words of a long text.
    """
    return F.substring_index(text, " ", -1)


def without_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def topic_name(category: Column) -> Column:
    """Destination topic of a category: its label without spaces."""
    return without_spaces(category)


def with_batch_topic(topic: Column) -> Column:
    """Name of the second topic that feeds the windowed job."""
    return F.concat(topic, F.lit(BATCH_SUFFIX))


def polarity(sentiment: Column, positive: str = POSITIVE_CODE) -> Column:
    """Two-way split: the positive code against everything else, nulls included."""
    yes, no = POLARITIES
    return F.when(sentiment == F.lit(positive), yes).otherwise(no)


def count_of(counts: Column, label: str) -> Column:
    """A label's count in a map of counts, zero when the label is absent."""
    return F.coalesce(F.try_element_at(counts, F.lit(label)), F.lit(0).cast("bigint"))
