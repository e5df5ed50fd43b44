"""Kafka output. Needs the connector named in ``tally.sources.kafka``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Writer options. Without ``topic`` each row goes to the topic in its ``topic`` column."""
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return options


def _payload(log: DataFrame, options: dict[str, str]) -> DataFrame:
    return log.select("value") if "topic" in options else log.select("value", "topic")


def kafka_write(log: DataFrame, options: dict[str, str]) -> None:
    _payload(log, options).write.format("kafka").options(**options).save()


def kafka_write_stream(
    log: DataFrame, options: dict[str, str], checkpoint: str
) -> DataStreamWriter:
    """Append mode. On a query without aggregation, update mode would give the same rows."""
    return (
        _payload(log, options)
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
