"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import cut

FIRST_DIGIT = 64
GROWTH = 16


def _split(rows: DataFrame, digit: list[Column]) -> tuple[list[str], DataFrame]:
    """Groups of ``rows`` by one more digit, but for groups of one row.

    Counts combine within tasks before the shuffle, so a group that holds a third of all rows
    sends one row a task. The new group's number is fixed as the table is written.
    """
    keys = [f"_k{i}" for i in range(len(digit))]
    groups = (
        rows.groupBy(*(c.alias(k) for c, k in zip(digit, keys)))
        .agg(F.count("*").alias("_size"), F.max("doc_id").alias("_keep"))
        .filter(F.col("_size") > 1)
    )
    return keys, cut(groups.withColumn("_next", F.monotonically_increasing_id()))


def _members(rows: DataFrame, digit: list[Column], keys: list[str], groups: DataFrame, how: str):
    keyed = rows.withColumns(dict(zip((f"_d{i}" for i in range(len(digit))), digit)))
    on = reduce(lambda a, b: a & b, (F.col(f"_d{i}") == F.col(k) for i, k in enumerate(keys)))
    return keyed.join(groups, on, how)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The group of identical texts that each row is in.

    Returns one row per input row: doc_id, keep_id (largest doc_id of the group), group_size,
    kept, text_sha256 (for the reader; equality is decided on the bytes alone).

    Texts are split by their length and first 64 bytes, then by the bytes up to 1,024
    then 16,384 and so on, until a group is one row or its texts have ended. Only rows that still share
    a group go on to the next round; the number of bytes seen grows 16-fold each time, so
    rounds are few even for very long texts.

    Null text counts as empty. Rows without doc_id are grouped too; keep_id is null if no
    row of the group has one. Of rows that repeat the largest doc_id and the text, one is
    kept, and all count in group_size. Other columns of ``docs`` are not read.
    """
    texts = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        texts.alias("_text"),
        F.octet_length(texts).alias("_bytes"),
    )
    sha = F.unhex(F.sha2("_text", 256)).alias("_sha")
    digit = [F.col("_bytes"), F.substring("_text", 1, FIRST_DIGIT)]
    keys, groups = _split(rows, digit)

    alone = _members(
        rows.select("doc_id", sha, "_bytes", digit[1].alias("_text")), digit, keys, groups, "left_anti"
    ).select("doc_id", "_sha")
    done: list[DataFrame] = []
    single = [alone]
    left = cut(
        _members(rows.select("*", sha), digit, keys, groups, "inner").select(
            "doc_id", "_sha", "_bytes", "_size", "_keep",
            F.col("_next").alias("_group"),
            F.when(F.col("_bytes") > FIRST_DIGIT, F.col("_text")).alias("_text"),
            F.monotonically_increasing_id().alias("_tag"),
        )
    )
    seen = FIRST_DIGIT
    while True:
        done.append(left.filter(F.col("_bytes") <= seen).select("doc_id", "_sha", "_group", "_size", "_keep", "_tag", F.lit(seen).alias("_seen")))
        rows = left.filter(F.col("_bytes") > seen).drop("_size", "_keep")
        if rows.isEmpty():
            break
        digit = [F.col("_group"), F.substring("_text", seen + 1, seen * (GROWTH - 1))]
        keys, groups = _split(rows, digit)
        seen *= GROWTH
        left = cut(
            _members(rows, digit, keys, groups, "left").select(
                "doc_id", "_sha", "_size", "_keep", "_tag",
                F.when(F.col("_size").isNotNull(), F.col("_bytes")).otherwise(0).alias("_bytes"),
                F.col("_next").alias("_group"),
                F.when(F.col("_size").isNotNull() & (F.col("_bytes") > seen), F.col("_text")).alias("_text"),
            )
        )
        single.append(left.filter(F.col("_size").isNull()).select("doc_id", "_sha"))
        left = left.filter(F.col("_size").isNotNull())

    grouped = reduce(DataFrame.unionByName, done)
    # Of rows that hold a group's largest id the one of least tag stays. Tags are written in the
    # table, and their least combines within tasks, so any number of such rows may repeat.
    is_last = F.col("doc_id").eqNullSafe(F.col("_keep"))
    least = grouped.filter(is_last).groupBy("_seen", "_group").agg(F.min("_tag").alias("_least"))
    last = grouped.filter(is_last).join(least.select("_least"), F.col("_tag") == F.col("_least"), "left")
    told = last.withColumn("kept", F.col("_least").isNotNull()).drop("_least").unionByName(
        grouped.filter(~is_last).withColumn("kept", F.lit(False))
    )
    shape = [F.lower(F.hex("_sha")).alias("text_sha256")]
    return (
        told.select("doc_id", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"), "kept", *shape)
        .unionByName(
            reduce(DataFrame.unionByName, single).select(
                "doc_id",
                F.col("doc_id").alias("keep_id"),
                F.lit(1).cast("long").alias("group_size"),
                F.lit(True).alias("kept"),
                *shape,
            )
        )
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep.

    All columns come back as they were. Only rows to drop are looked up, by id and text
    digest. Of rows that repeat both, one stays, whichever columns the others have.
    """
    losers = exact_groups(docs, id_col, text_col).filter(F.col("group_size") > 1)
    lost = losers.groupBy("doc_id", "text_sha256").agg(
        F.sum(F.col("kept").cast("long")).alias("_kept"), F.count("*").alias("_rows")
    )
    gone = lost.filter(F.col("_kept") == 0).select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")
    )
    repeated = lost.filter((F.col("_kept") == 1) & (F.col("_rows") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")
    )
    marks = cut(
        gone.withColumn("_gone", F.lit(True)).unionByName(
            repeated.withColumn("_gone", F.lit(False))
        )
    )
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    text = F.coalesce(F.col(f"_row.{text_col}"), F.lit("")).cast("binary")
    rows = docs.select(row).withColumn("_own", F.sha2(text, 256))
    on = F.col(f"_row.{id_col}").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    marked = rows.join(marks, on, "left").filter(~F.coalesce("_gone", F.lit(False)))
    twice = marked.filter(F.col("_gone").isNotNull()).dropDuplicates(["_id", "_digest"])
    rest = marked.filter(F.col("_gone").isNull())
    return rest.unionByName(twice).select("_row.*")
