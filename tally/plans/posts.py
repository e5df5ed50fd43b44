"""The post stream: counts per sentiment of each batch, and polarity totals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.functions import decode, polarity
from tally.operators import count_by, document
from tally.plans.endpoints import Documents, Endpoint
from tally.schemas import POLARITIES, POSITIVE_CODE, POST_SENTIMENT, POST_TOPIC
from tally.streaming import observed, snapshot_sink, start

SENTIMENTS = ("0", "1")


def sentiment_document(
    write: Callable[[DataFrame, int], None], sentiments: Sequence[str] = SENTIMENTS
) -> Callable[[DataFrame, int], None]:
    """Per-batch callback that writes one document of counts, keyed by the batch. Codes
    that are not among ``sentiments``, and missing ones, are counted together."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write(document(batch, sentiments, "sentiment", other="other"), batch_id)

    return sink


def polarity_totals(posts: DataFrame, positive: str = POSITIVE_CODE) -> DataFrame:
    side = polarity(F.col("sentiment"), positive).alias("polarity")
    return count_by(posts.select(side), "polarity")


def start_posts(
    spark: SparkSession,
    source: Endpoint,
    documents: Documents,
    totals: Callable[[DataFrame, int], None],
    checkpoint: str,
    positive: str = POSITIVE_CODE,
    once: bool = False,
) -> list[StreamingQuery]:
    """Two queries over the topic of posts. A callback gets its batch already computed, so
    nothing would prune the unread fields there: only the sentiment is decoded."""
    posts = decode(source.stream(spark, [POST_TOPIC], checkpoint), POST_SENTIMENT)
    return [
        start(
            posts,
            f"{checkpoint}/documents",
            sentiment_document(documents.writer()),
            once=once,
            name="post-documents",
        ),
        start(
            observed(polarity_totals(posts, positive), POLARITIES, "polarity"),
            f"{checkpoint}/totals",
            snapshot_sink(totals, POLARITIES, "polarity"),
            mode="complete",
            once=once,
            state_width=len(POLARITIES),
            name="post-totals",
        ),
    ]
