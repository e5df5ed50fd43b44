"""Outputs. All of them are written by the executors."""

from tally.sinks.batches import write_batch
from tally.sinks.console import print_batch
from tally.sinks.documents import document_options, documents, write_documents
from tally.sinks.kafka import kafka_sink_options, kafka_write, kafka_write_stream
from tally.sinks.topics import publish, publish_stream, topic_writer

__all__ = [
    "document_options",
    "documents",
    "kafka_sink_options",
    "kafka_write",
    "kafka_write_stream",
    "print_batch",
    "publish",
    "publish_stream",
    "topic_writer",
    "write_batch",
    "write_documents",
]
