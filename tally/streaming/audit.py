"""What a query keeps in its state store, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(
    spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0
) -> DataFrame:
    """Keys and values of a stateful operator as plain columns, after a batch (the last one if
    none is named). The query need not run; executors read a state partition each."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "value.*")


def state_totals(
    spark: SparkSession, checkpoint: str, column: str = "issue", batch_id: int | None = None
) -> DataFrame:
    """Totals per category as the state store holds them, to be held against what was
    published: (category, n)."""
    rows = state_rows(spark, checkpoint, batch_id)
    key, count = rows.columns
    return rows.select(F.col(f"`{key}`").alias(column), F.col(f"`{count}`").alias("n"))
