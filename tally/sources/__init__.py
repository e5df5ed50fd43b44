"""Inputs: delimited files, topic logs on files, Kafka topics."""

from tally.sources.delimited import delimited_stream, delimited_table
from tally.sources.kafka import kafka_options, kafka_stream, kafka_table
from tally.sources.topics import (
    bytes_per_trigger,
    file_stream,
    later_only,
    latest_batch,
    read_batches,
    topic_batches,
    topic_stream,
    topic_table,
)

__all__ = [
    "bytes_per_trigger",
    "delimited_stream",
    "delimited_table",
    "file_stream",
    "kafka_options",
    "kafka_stream",
    "kafka_table",
    "later_only",
    "latest_batch",
    "read_batches",
    "topic_batches",
    "topic_stream",
    "topic_table",
]
