"""The report stream: records, republished records, rejected payloads and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.functions import decode_checked, encode
from tally.operators import count_by, quarantine, tracked, wanted
from tally.plans.endpoints import Documents, Endpoint
from tally.plans.publisher import REPORT_FIELDS
from tally.schemas import ISSUES, REPORT, REPUBLISH_TOPIC, TOTALS_TOPIC
from tally.streaming import count_ledger, fan_out, ledger_sink, start

# Where a job keeps the ledger of its totals, below its checkpoint.
LEDGER = "ledger"


def topics_of(labels: Sequence[str], suffix: str = "") -> list[str]:
    """Topics of the labels, by the rule of ``topic_name``."""
    return [label.replace(" ", "") + suffix for label in labels]


def record_outputs(
    documents, republish, rejected, lineage: Sequence[str] = (), labels: Sequence[str] = ISSUES, totals=None
) -> dict:
    """Outputs of one decoded batch, for ``fan_out``: tracked records as documents and as
    JSON payloads, everything else with the reason for its rejection, and counts for
    ``totals`` if that is given."""

    def records(batch: DataFrame) -> DataFrame:
        return tracked(batch, labels).select(*REPORT_FIELDS, *lineage)

    outputs = {
        "records": (records, documents),
        "republished": (lambda b: encode(records(b), REPORT_FIELDS), republish),
        "rejected": (lambda b: quarantine(b, labels), rejected),
    }
    if totals is not None:
        outputs["totals"] = (lambda b: count_by(tracked(b, labels), "issue"), totals)
    return outputs


def start_reports(
    spark: SparkSession,
    source: Endpoint,
    out: Endpoint,
    documents: Documents,
    rejected: Documents,
    checkpoint: str,
    labels: Sequence[str] = ISSUES,
    once: bool = False,
) -> list[StreamingQuery]:
    """One query over the topics of ``labels``, which writes records and totals of the same
    batches: the topics are read once, and after any failure the two agree once the batch
    has been repeated. Totals are kept as a ledger below the checkpoint.
    """
    log = source.stream(spark, topics_of(labels), checkpoint)
    record_key, reject_key = documents.key(source.lineage), rejected.key(source.lineage)
    checked = decode_checked(log, REPORT, keep=record_key or reject_key)
    # The batch is kept while it is written, so it carries no text that no output needs.
    lean = checked.withColumn("raw", F.when(~wanted(labels) | F.col("rest"), F.col("raw")))
    outputs = record_outputs(
        documents.writer(record_key),
        out.writer(REPUBLISH_TOPIC),
        rejected.writer(reject_key),
        record_key,
        labels,
        ledger_sink(count_ledger(f"{checkpoint}/{LEDGER}", labels), out.writer(TOTALS_TOPIC), labels),
    )
    return [start(lean, f"{checkpoint}/records", fan_out(outputs), once=once, name="reports")]
