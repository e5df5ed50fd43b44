"""Delimited files with a header line. Every column is text; names come from the header."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# The largest file that is read whole, by one task.
WHOLE_BYTES = 1 << 30


def _options(multiline: bool) -> dict[str, str]:
    # A quote inside a quoted field is written twice. Line breaks inside a field make a file
    # unsplittable, so they have to be asked for. With a header that differs from the
    # schema the read fails; by default Spark would assign columns by position. A quoted
    # empty field is an empty text: it is null by default, as it equals the null text, which
    # is therefore set to something no field holds. An unquoted one stays null.
    return {
        "header": "true",
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "enforceSchema": "false",
        "nullValue": "\u0000",
    }


def _text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def split_or_whole(
    spark: SparkSession, path: str | list[str], most_bytes: int = WHOLE_BYTES
) -> tuple[list[str], list[str]]:
    """Files that can be read in splits, and those in which a quoted field holds a line break,
    so that they have to be read whole.

    A line that such a field is broken in has an odd number of quotes, as quotes in a field
    are written twice. The lines are read once for it, in splits; the driver gets the names.
    A file of more than ``most_bytes`` that would have to go through one task is an error.
    """
    value = F.col("value")
    odd = (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1
    lines = spark.read.text(path).select("_metadata.file_path", "_metadata.file_size", odd.alias("odd"))
    files = lines.groupBy("file_path", "file_size").agg(F.max("odd").alias("odd")).collect()
    large = [r.file_path for r in files if r.odd and r.file_size > most_bytes]
    if large:
        raise ValueError(f"fields with line breaks in files over {most_bytes} bytes: {large}")
    names = lambda whole: sorted(unquote(r.file_path) for r in files if r.odd == whole)
    return names(False), names(True)


def delimited_table(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    multiline: bool | None = False,
    most_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """Without ``columns`` the header of the first file names them, at the cost of reading
    that one line when the plan is made.

    ``multiline`` tells whether quoted fields may hold line breaks. With None each file is
    read as it needs, see ``split_or_whole``.
    """
    if multiline is None:
        split, whole = split_or_whole(spark, path, most_bytes)
        if not whole:
            return delimited_table(spark, path, columns)
        if columns is None:
            columns = delimited_table(spark, whole[:1], multiline=True).columns
        rows = delimited_table(spark, whole, columns, multiline=True)
        return rows.unionByName(delimited_table(spark, split, columns)) if split else rows
    reader = spark.read.options(**_options(multiline))
    if columns is not None:
        reader = reader.schema(_text_schema(columns))
    return reader.csv(path)


def delimited_stream(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    multiline: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """Files that arrive in a folder. Without ``columns`` one file must be there already."""
    if columns is None:
        columns = delimited_table(spark, path, multiline=multiline).columns
    reader = spark.readStream.schema(_text_schema(columns)).options(**_options(multiline))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.csv(path)
