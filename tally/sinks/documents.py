"""Document output: one document per record, or one per batch.

The document store's Spark connector (``org.mongodb.spark:mongo-spark-connector``) has to be
on the class path; without it, JSON files take the documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions import quoted
from tally.operators.counts import tag_batch
from tally.sinks.batches import write_batch


def document_options(uri: str, database: str, collection: str) -> dict[str, str]:
    """Replace by ``_id``, so writing a document again changes nothing."""
    return {
        "connection.uri": uri,
        "database": database,
        "collection": collection,
        "operationType": "replace",
        "idFieldList": "_id",
        "upsertDocument": "true",
    }


def documents(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Put the document key in place of the columns that identify the row: topic, partition
    and offset for a record, the batch id for a batch's counts."""
    identity = F.concat_ws("-", *[quoted(c).cast("string") for c in key]).alias("_id")
    return df.select(identity, *[quoted(c) for c in df.columns if c not in key])


def write_documents(
    df: DataFrame,
    batch_id: int,
    key: Sequence[str] = (),
    options: dict[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Write one micro-batch, to the store if ``options`` are given, else below ``path``.

    In the store a row is known by its ``key`` columns; without any, it is the only row of
    its run's batch. Below ``path`` the batch's folder does that, and no key is needed; each document
    holds its batch id as well, so that it can be placed without the folder.
    """
    tagged = tag_batch(df, batch_id)
    if options is not None:
        named = tagged.withColumn("batch_id", F.lit(getattr(batch_id, "key", str(batch_id))))
        keyed = documents(tagged, key).drop("batch_id") if key else documents(named, ["batch_id"])
        keyed.write.format("mongodb").mode("append").options(**options).save()
    elif path is not None:
        write_batch(tagged, path, batch_id, "json")
    else:
        raise ValueError("give connector options or a path")
