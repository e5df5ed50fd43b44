"""Where a job's topics live: Kafka brokers, or folders on shared storage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tally import sinks, sources

Write = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Files:
    """Topic logs below ``path``."""

    path: str
    max_bytes: int | None = None
    ignore_missing: bool = False
    start: str = "earliest"

    lineage = ("topic", "file", "row")

    def _log(self, spark: SparkSession, topics: Sequence[str], checkpoint: str | None) -> DataFrame:
        log = sources.topic_stream(spark, self.path, topics, self.max_bytes, self.ignore_missing)
        if self.start == "latest":
            if checkpoint is None:
                raise ValueError("the latest position is kept at a checkpoint")
            log = sources.later_only(log, self.path, checkpoint)
        return log

    def stream(
        self, spark: SparkSession, topics: Sequence[str], checkpoint: str | None = None
    ) -> DataFrame:
        """Payloads with the place of each: the file and its row in it take the part that
        partition and offset have in Kafka. ``checkpoint`` is the job's; a start at the latest
        position is kept there."""
        return self._log(spark, topics, checkpoint).select(
            "value",
            "topic",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )

    def outputs(self, spark: SparkSession, topic: str, checkpoint: str | None = None) -> DataFrame:
        """What ``writer`` has left for a topic, as a stream of payloads with run, batch and
        time of writing of each. The store's log lists a batch once, so none comes twice."""
        log = self._log(spark, [topic], checkpoint)
        return log.select(
            F.col("value").cast("string").alias("value"),
            F.col("run").cast("string").alias("run"),
            "batch_id",
            F.col("_metadata.file_modification_time").alias("written"),
        )

    def publish(self, log: DataFrame) -> None:
        sinks.publish(log, self.path)

    def publish_stream(self, log: DataFrame, checkpoint: str) -> DataStreamWriter:
        return sinks.publish_stream(log, self.path, checkpoint)

    def writer(self, topic: str) -> Write:
        """Per-batch writer to one topic; a repeated batch counts once."""
        write = sinks.topic_writer(self.path, topic)
        return lambda df, batch_id: write(df.select("value"), batch_id)


@dataclass(frozen=True)
class Kafka:
    """Topics of a Kafka cluster."""

    servers: str
    start: str = "earliest"
    fail_on_data_loss: bool = True
    max_offsets: int | None = None
    min_partitions: int | None = None

    lineage = ("topic", "partition", "offset")

    def stream(
        self,
        spark: SparkSession,
        topics: Sequence[str],
        checkpoint: str | None = None,
        lineage: Sequence[str] = lineage,
    ) -> DataFrame:
        """Payloads with the place of each. Spark keeps the position in the checkpoint."""
        options = sources.kafka_options(
            self.servers,
            topics,
            self.start,
            self.fail_on_data_loss,
            self.max_offsets,
            self.min_partitions,
        )
        return sources.kafka_stream(spark, options, lineage)

    def outputs(self, spark: SparkSession, topic: str, checkpoint: str | None = None) -> DataFrame:
        """What ``writer`` has sent to a topic, with run, batch and time of each message."""
        sent = self.stream(spark, [topic], lineage=["key", "timestamp"])
        key = F.col("key").cast("string")
        return sent.select(
            "value",
            F.regexp_extract(key, "^(.*)/", 1).alias("run"),
            F.substring_index(key, "/", -1).cast("bigint").alias("batch_id"),
            F.col("timestamp").alias("written"),
        )

    def publish(self, log: DataFrame) -> None:
        sinks.kafka_write(log, sinks.kafka_sink_options(self.servers))

    def publish_stream(self, log: DataFrame, checkpoint: str) -> DataStreamWriter:
        return sinks.kafka_write_stream(log, sinks.kafka_sink_options(self.servers), checkpoint)

    def writer(self, topic: str) -> Write:
        """Per-batch writer. Kafka cannot replace what a failed attempt has sent, so each
        message has run and batch as its key, by which a reader can drop repeats."""
        options = sinks.kafka_sink_options(self.servers, topic)

        def write(df: DataFrame, batch_id: int) -> None:
            key = getattr(batch_id, "key", str(batch_id))
            keyed = df.select("value", F.lit(key).alias("key"))
            keyed.write.format("kafka").options(**options).save()

        return write


Endpoint = Files | Kafka


@dataclass(frozen=True)
class Documents:
    """A document store, or JSON files below ``path``."""

    options: dict[str, str] | None = None
    path: str | None = None

    def key(self, lineage: Sequence[str]) -> Sequence[str]:
        """The columns by which documents are told apart, as far as they have to be."""
        return lineage if self.options is not None else ()

    def writer(self, key: Sequence[str] = ()) -> Write:
        return lambda df, batch_id: sinks.write_documents(
            df, batch_id, key, self.options, self.path
        )
