"""Kafka topics. The connector is a separate Spark package and has to be on the class path
(``org.apache.spark:spark-sql-kafka-0-10``); these functions only hold its configuration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STARTS = ("earliest", "latest")


def kafka_options(
    servers: str,
    topics: Sequence[str],
    start: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``start`` counts only for a query that has no checkpoint yet.

    ``min_partitions`` splits offset ranges further than one task per topic partition, for
    a topic where one partition holds much of the data.
    """
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}: {start!r}")
    if not topics:
        raise ValueError("no topic to read")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(
    spark: SparkSession, options: dict[str, str], lineage: Sequence[str] = ()
) -> DataFrame:
    """``value``, and whichever of topic, partition, offset and timestamp are named."""
    return spark.readStream.format("kafka").options(**options).load().select(
        "value", *map(F.col, lineage)
    )


def kafka_table(
    spark: SparkSession, options: dict[str, str], lineage: Sequence[str] = ()
) -> DataFrame:
    """The topics' present content. A batch read can only begin at the earliest offset."""
    if options.get("startingOffsets") == "latest":
        raise ValueError("a batch read cannot start at the latest offset")
    return spark.read.format("kafka").options(**options).load().select(
        "value", *map(F.col, lineage)
    )
