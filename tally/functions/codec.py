"""Records to payloads and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.columns import quoted
from tally.schemas import SNAPSHOT

CORRUPT = "_corrupt_record"


def json_text(*columns: str) -> Column:
    """JSON object of the given columns, all of them by default. Null fields are left out."""
    fields = [quoted(c) for c in columns] or [F.col("*")]
    return F.to_json(F.struct(*fields))


def snapshot_json(labels: Sequence[str]) -> Column:
    """JSON object of one count per label, in the order of ``labels``."""
    return F.to_json(F.struct(*[quoted(label) for label in labels]))


def encode(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One UTF-8 JSON payload per record, in ``value``, next to the ``keep`` columns."""
    return df.select(json_text(*columns).cast("binary").alias("value"), *map(quoted, keep))


def decode(
    log: DataFrame, schema: str, keep: Sequence[str] = (), filtered: bool = False
) -> DataFrame:
    """Payloads as flat records of ``schema``; what cannot be decoded becomes nulls.

    ``from_json`` carries no options on purpose: only then does the optimizer drop the
    fields that no one reads from the parse.

    Set ``filtered`` where a filter on a record field follows. The optimizer moves such a
    filter below the projection, parser included, and every payload that passes would be
    parsed twice. A generator stops that; as it stops the pruning too, name in ``schema``
    only the fields that are needed.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    if filtered:
        return log.select(F.inline(F.array(data)), *map(quoted, keep))
    return log.select(data.alias("data"), *map(quoted, keep)).select(
        "data.*", *map(quoted, keep)
    )


def decode_checked(log: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """As ``decode`` for a filter to follow, with the payload text as ``raw`` and a
    ``corrupt`` flag.

    The decoded struct is not null even for text that is no JSON object, so the parser's
    own record of rejected text decides, together with absent and empty payloads. Its column
    is named here, whatever the session calls it.

    The parser stops at the end of the first object. ``rest`` is true where the text goes on
    after it: the record is that first object, and what follows is in ``raw`` only.
    """
    text = F.col("value").cast("string")
    data = F.from_json(
        text, f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}
    )
    # As the content of an array, a text of one object makes an array of one. An object ends
    # with a brace, so nothing follows it where the text's first closing brace is its last
    # character, and something does where the last one is none; only other texts are parsed
    # for what follows.
    trimmed = F.rtrim(text, F.lit(" \t\r\n"))
    single = F.instr(trimmed, "}") == F.length(trimmed)
    whole = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string, string>>")
    more = ~trimmed.endswith("}") | (F.coalesce(F.size(whole), F.lit(0)) != 1)
    rest = F.when(single | ~F.ltrim(text).startswith("{"), False).otherwise(more)
    return (
        log.select(
            text.alias("raw"),
            F.inline(F.array(data)),
            F.coalesce(rest, F.lit(False)).alias("rest"),
            *map(quoted, keep),
        )
        .withColumn("corrupt", F.col(CORRUPT).isNotNull() | (F.coalesce("raw", F.lit("")) == ""))
        .withColumn("rest", F.col("rest") & ~F.col("corrupt"))
        .drop(CORRUPT)
    )


def decode_snapshots(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Totals messages as maps in ``counts``."""
    text = F.col("value").cast("string")
    return log.select(F.from_json(text, SNAPSHOT).alias("counts"), *map(quoted, keep))
