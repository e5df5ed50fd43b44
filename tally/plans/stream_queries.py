"""Registered queries that run as streams, each with the SQL that must give the same rows.

A query publishes a table to a topic log, replays the log in a few batches, waits for the
end, and returns a read of what was written. Its files are in a scratch folder of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import decode, encode
from tally.operators import add_up, count_by, event_windows, label_rows, snapshot_sums, window_rows
from tally.plans import batch_queries as batch
from tally.plans import inputs
from tally.plans.endpoints import Documents, Files
from tally.plans.inputs import TRACKED, TRIGGERS, UNTRACKED
from tally.plans.posts import SENTIMENTS, start_posts
from tally.plans.publisher import publish_reports_stream
from tally.plans.reports import LEDGER, start_reports, topics_of
from tally.plans.shares import start_shares
from tally.plans.windows import start_untimed, start_window_table, start_windows
from tally.schemas import (
    BATCH_SUFFIX,
    POST_TOPIC,
    REPORT,
    REPORT_COLUMNS,
    REPORT_ISSUE,
    REPUBLISH_TOPIC,
    TOTALS_TOPIC,
    WINDOW_TOTALS_TOPIC,
)
from tally.session import scratch
from tally.sinks import publish, write_batch
from tally.sources import (
    bytes_per_trigger,
    delimited_stream,
    latest_batch,
    read_batches,
    topic_batches,
    topic_table,
)
from tally.streaming import (
    finish,
    latest_totals,
    ledger_history,
    ledger_totals,
    running_totals,
    snapshot_sink,
    start,
    state_totals,
    to_folder,
)

# Parts of a log that grows while a job is started again and again.
PARTS = 3
# How late a row may come in windows of the records' own times.
LATE = "1 hour"

# Files of a small log, so that its replay takes several batches.
FILES = 2 * TRIGGERS

WINDOW_ROW = "window_start timestamp_ntz, window_end timestamp_ntz, issue string, n bigint"


def _replay(spark: SparkSession, log: DataFrame, folder: str) -> Files:
    """Publish ``log`` and bound the triggers of those who read it."""
    path = f"{folder}/topics"
    publish(log, path)
    return Files(path, bytes_per_trigger(spark, path, TRIGGERS))


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files, as they arrive, to the topics of both families."""
    folder = scratch(spark, "publish")
    rows = inputs.report_rows(spark, sf_dir).repartition(FILES, REPORT_COLUMNS["id"])
    inputs.write_delimited(rows, f"{folder}/csv")
    out = Files(f"{folder}/topics")
    bound = bytes_per_trigger(spark, f"{folder}/csv", TRIGGERS)
    rows = delimited_stream(spark, f"{folder}/csv", max_bytes=bound)
    finish(publish_reports_stream(rows, out, f"{folder}/checkpoint", TRACKED, once=True))
    topics = topics_of(TRACKED) + topics_of(TRACKED, BATCH_SUFFIX)
    return decode(topic_table(spark, out.path, topics), REPORT, keep=["topic"])


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "append")
    source = _replay(spark, inputs.report_log(spark, sf_dir), folder)
    records = decode(source.stream(spark, topics_of(TRACKED)), REPORT)
    finish(start(records, f"{folder}/checkpoint", path=f"{folder}/records", once=True))
    return spark.read.schema(REPORT).parquet(f"{folder}/records")


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _run_totals(spark, sf_dir)
    return latest_totals(read_batches(spark, f"{folder}/snapshots", "value string"))


def _run_totals(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "totals")
    source = _replay(spark, inputs.report_log(spark, sf_dir), folder)
    log = source.stream(spark, topics_of(TRACKED))
    records = decode(log, REPORT_ISSUE, filtered=True)
    sink = snapshot_sink(to_folder(f"{folder}/snapshots"), TRACKED)
    finish(
        start(
            running_totals(records, TRACKED),
            f"{folder}/checkpoint",
            sink,
            mode="complete",
            once=True,
            state_width=len(TRACKED),
        )
    )
    return folder


def stream_polarity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job of the post stream; its totals."""
    folder = _run_posts(spark, sf_dir)
    return latest_totals(read_batches(spark, f"{folder}/totals", "value string"), "polarity")


def stream_batch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job of the post stream, started again for each part of the log, which is a batch
    then; its documents, each with its batch id."""
    folder = scratch(spark, "documents")
    source = Files(f"{folder}/topics")
    posts = inputs.posts(spark, sf_dir).withColumn("topic", F.lit(POST_TOPIC))
    for k in range(PARTS):
        part = posts.filter(F.col("id").cast("bigint") % PARTS == k)
        publish(encode(part, ["id", "sentiment", "hashtag"], ["topic"]), source.path)
        finish(
            *start_posts(
                spark,
                source,
                Documents(path=f"{folder}/documents"),
                to_folder(f"{folder}/totals"),
                f"{folder}/checkpoint",
                once=True,
            )
        )
    names = [*SENTIMENTS, "other"]
    schema = ", ".join(f"`{c}` bigint" for c in ["batch_id", *names])
    return spark.read.schema(schema).json(f"{folder}/documents").select("batch_id", *names)


def _run_posts(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "posts")
    # Tokens are taken before the join with the labels, so no text is shuffled.
    posts = inputs.posts(spark, sf_dir).withColumn("topic", F.lit(POST_TOPIC))
    log = encode(posts, ["id", "sentiment", "hashtag"], ["topic"])
    source = _replay(spark, log.repartition(FILES, "value"), folder)
    queries = start_posts(
        spark,
        source,
        Documents(path=f"{folder}/documents"),
        to_folder(f"{folder}/totals"),
        f"{folder}/checkpoint",
        once=True,
    )
    finish(*queries)
    return folder


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch writes the windows that it changed; the newest count of each is the result."""
    folder = scratch(spark, "windows")
    source = _replay(spark, inputs.report_log(spark, sf_dir, to="batch"), folder)
    topics = topics_of([*TRACKED, UNTRACKED], BATCH_SUFFIX)
    records = decode(source.stream(spark, topics), REPORT)
    timed = records.select(F.col("datetime").try_cast("timestamp_ntz").alias("ts"), "issue")
    finish(
        start(
            window_rows(event_windows(timed)),
            f"{folder}/checkpoint",
            to_folder(f"{folder}/table"),
            mode="update",
            once=True,
            # Here a task may send rows of very many windows, so the width follows the
            # cluster and not the number of categories.
            state_width=spark.sparkContext.defaultParallelism,
        )
    )
    table = read_batches(spark, f"{folder}/table", WINDOW_ROW)
    newest = F.max_by("n", F.struct("run", "batch_id")).alias("n")
    return table.groupBy("window_start", "window_end", "issue").agg(newest)


def stream_processing_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job of the windows. By the clock they differ from run to run; the totals rolled up
    from them do not."""
    folder = scratch(spark, "clock")
    source = _replay(spark, inputs.report_log(spark, sf_dir, to="batch"), folder)
    out = Files(f"{folder}/out")
    table = to_folder(f"{folder}/table")
    finish(start_windows(spark, source, out, f"{folder}/checkpoint", table, TRACKED, once=True))
    return latest_totals(topic_batches(spark, out.path, WINDOW_TOTALS_TOPIC))


def stream_window_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the records' own times, each once when it is over. The log grows in order
    of time, and the job is started again for each part."""
    folder = scratch(spark, "closed")
    source = Files(f"{folder}/topics")
    for part in inputs.in_time_order(inputs.reports(spark, sf_dir), PARTS):
        publish(inputs.as_log(part, to="batch"), source.path)
        finish(
            start_window_table(
                spark,
                source,
                f"{folder}/table",
                f"{folder}/checkpoint",
                TRACKED,
                delay=LATE,
                once=True,
                event_time=True,
                state_width=spark.sparkContext.defaultParallelism,
            )
        )
    schema = "window_start timestamp, window_end timestamp, issue string, n bigint"
    table = spark.read.schema(schema).parquet(f"{folder}/table")
    bounds = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return table.select(*bounds, "issue", "n")


def stream_windows_and_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the records' own times where some records have none: what the windows hold
    and what is set aside make up the input. Also the totals that the job publishes."""
    folder = scratch(spark, "timed")
    source, out = Files(f"{folder}/topics"), Files(f"{folder}/out")
    number = F.col("id").cast("bigint")
    text = F.when(number % 10 == 1, "soon").when(number % 10 != 0, F.col("datetime"))
    rejected = Documents(path=f"{folder}/rejected")
    for part in inputs.in_time_order(inputs.reports(spark, sf_dir), PARTS):
        publish(inputs.as_log(part.withColumn("datetime", text), to="batch"), source.path)
        checkpoint, table = f"{folder}/checkpoint", to_folder(f"{folder}/table")
        finish(
            start_windows(
                spark, source, out, checkpoint, table, TRACKED, once=True, event_time=True, delay=LATE,
                state_width=spark.sparkContext.defaultParallelism,
            ),
            start_untimed(spark, source, rejected, checkpoint, TRACKED, once=True),
        )
    schema = "window_start timestamp, window_end timestamp, issue string, n bigint"
    changed = read_batches(spark, f"{folder}/table", schema)
    newest = F.max_by("n", F.struct("run", "batch_id")).alias("n")
    windows = changed.groupBy("window_start", "issue").agg(newest)
    untimed = spark.read.schema("reason string").json(f"{folder}/rejected")
    parts = {
        "windows": add_up(windows, "issue", name="n"),
        "totals": latest_totals(topic_batches(spark, out.path, WINDOW_TOTALS_TOPIC)),
        "untimed": count_by(untimed, "reason").withColumnRenamed("reason", "issue"),
    }
    return _by_output(parts)


def _by_output(parts: dict[str, DataFrame]) -> DataFrame:
    named = [part.select(F.lit(name).alias("output"), "issue", "n") for name, part in parts.items()]
    result = named[0]
    for part in named[1:]:
        result = result.unionByName(part)
    return result


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the report job: its last totals, and the same from the counts of all
    batches, as sums over their history."""
    folder = scratch(spark, "ledger")
    source = _replay(spark, inputs.report_log(spark, sf_dir), folder)
    checkpoint = f"{folder}/checkpoint"
    finish(
        *start_reports(
            spark, source, Files(f"{folder}/out"), Documents(path=f"{folder}/records"),
            Documents(path=f"{folder}/rejected"), checkpoint, TRACKED, once=True,
        )
    )
    ledger = f"{checkpoint}/{LEDGER}"
    history = ledger_history(spark, ledger, TRACKED)
    last = history.agg(*[F.max_by(v, "batch_id").alias(v) for v in TRACKED])
    totals = ledger_totals(spark, ledger).withColumnRenamed("n", "total")
    return label_rows(last, TRACKED).join(F.broadcast(totals), "issue").select("issue", "n", "total")


def stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals read back from the state store of the query that keeps them."""
    return state_totals(spark, f"{_run_totals(spark, sf_dir)}/checkpoint")


def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader of the totals topic that adds up every snapshot it receives."""
    folder = scratch(spark, "snapshots")
    messages = batch.snapshot_publish(spark, sf_dir).select(
        F.col("value").cast("binary").alias("value"), F.lit(TOTALS_TOPIC).alias("topic")
    )
    source = _replay(spark, messages.repartition(FILES, "value"), folder)
    received = batch.decode_snapshots(source.stream(spark, [TOTALS_TOPIC]))
    finish(
        start(
            snapshot_sums(received, TRACKED),
            f"{folder}/checkpoint",
            to_folder(f"{folder}/sums"),
            mode="complete",
            once=True,
            state_width=len(TRACKED),
        )
    )
    sums = latest_batch(read_batches(spark, f"{folder}/sums", "issue string, n bigint"))
    return sums.select("issue", "n")


def stream_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job that reads a totals topic; its newest table of sums and shares. The writer
    repeats its first batch after the job has read it, which changes nothing."""
    folder = scratch(spark, "shares")
    source = Files(f"{folder}/topics")
    messages = batch.snapshot_publish(spark, sf_dir).select("value")
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    send = source.writer(TOTALS_TOPIC)
    write = to_folder(f"{folder}/table")
    for sent in ([0], [1, 0]):
        for k in sent:
            send(messages.filter(part == k), k)
        finish(start_shares(spark, source, write, folder, labels=TRACKED, once=True))
    table = read_batches(spark, f"{folder}/table", "issue string, n bigint, share double")
    return latest_batch(table).select("issue", "n", "share")


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job of the report stream over a log that holds foreign payloads too; rows per
    output and category, or reason of rejection, and the totals kept beside them."""
    folder = scratch(spark, "fanout")
    source = _replay(spark, inputs.mixed_log(spark, sf_dir), folder)
    out = Files(f"{folder}/out")
    queries = start_reports(
        spark,
        source,
        out,
        Documents(path=f"{folder}/records"),
        Documents(path=f"{folder}/rejected"),
        f"{folder}/checkpoint",
        TRACKED,
        once=True,
    )
    finish(*queries)
    records = spark.read.schema(REPORT).json(f"{folder}/records")
    rejected = spark.read.schema("reason string").json(f"{folder}/rejected")
    republished = topic_batches(spark, out.path, REPUBLISH_TOPIC)
    totals = topic_batches(spark, out.path, TOTALS_TOPIC)
    parts = {
        "records": count_by(records, "issue"),
        "republished": count_by(decode(republished, REPORT), "issue"),
        "rejected": count_by(rejected, "reason").withColumnRenamed("reason", "issue"),
        "totals": latest_totals(totals),
    }
    return _by_output(parts)


TOTALS_SQL = batch.QUERIES["multi_source_union"][1]

QUERIES = {
    "stream_publish": (
        stream_publish,
        f"""
    SELECT r.*, r.issue || s.suffix AS topic
    FROM ({batch.REPORTS_SQL}) r CROSS JOIN (VALUES (''), ('_batch')) AS s(suffix)
    WHERE r.issue IN {batch.TRACKED_SQL}""",
    ),
    "stream_append": (stream_append, batch.QUERIES["filter_tracked"][1]),
    "stream_running_totals": (stream_running_totals, TOTALS_SQL),
    "stream_polarity_totals": (stream_polarity_totals, batch.QUERIES["polarity_totals"][1]),
    "stream_batch_documents": (
        stream_batch_documents,
        f"""
    SELECT CAST(id AS BIGINT) % {PARTS} AS batch_id, count(*) FILTER (WHERE sentiment = '0') AS "0",
           count(*) FILTER (WHERE sentiment = '1') AS "1",
           count(*) FILTER (WHERE sentiment IS NULL OR sentiment NOT IN ('0', '1')) AS other
    FROM ({batch.POSTS_SQL}) GROUP BY 1""",
    ),
    "stream_window_table": (
        stream_window_table,
        f"""
    SELECT * FROM ({batch.WINDOWS_SQL})
    WHERE issue IN {batch.TRACKED_SQL} AND window_end <= (
        SELECT max(ts) - INTERVAL '{LATE}' FROM events WHERE event_type IN {batch.TRACKED_SQL})""",
    ),
    "stream_windows_and_untimed": (
        stream_windows_and_untimed,
        f"""
    WITH r AS (SELECT event_id % 10 AS d, event_type AS issue FROM events WHERE event_type IN {batch.TRACKED_SQL})
    SELECT o.output, issue, count(*) AS n
    FROM r CROSS JOIN (VALUES ('windows'), ('totals')) AS o(output) WHERE d > 1 GROUP BY ALL
    UNION ALL
    SELECT 'untimed', CASE d WHEN 0 THEN 'no time' ELSE 'unreadable time' END, count(*)
    FROM r WHERE d <= 1 GROUP BY ALL""",
    ),
    "stream_ledger": (stream_ledger, f"SELECT issue, n, n AS total FROM ({TOTALS_SQL})"),
    "stream_state_audit": (stream_state_audit, TOTALS_SQL),
    "stream_window_counts": (stream_window_counts, batch.WINDOWS_SQL),
    "stream_processing_time_window": (stream_processing_time_window, TOTALS_SQL),
    "stream_snapshots": (stream_snapshots, batch.QUERIES["snapshot_accumulate"][1]),
    "stream_shares": (
        stream_shares,
        f"""
    WITH c AS ({batch.QUERIES["snapshot_accumulate"][1]})
    SELECT issue, n, round(100.0 * n / sum(n) OVER (), 2) AS share FROM c""",
    ),
    "stream_fanout": (
        stream_fanout,
        f"""
    WITH c AS ({TOTALS_SQL})
    SELECT o.output, c.issue, c.n
    FROM c CROSS JOIN (VALUES ('records'), ('republished'), ('totals')) AS o(output)
    UNION ALL
    SELECT 'rejected', reason, count(*)
    FROM ({batch.QUERIES["quarantine_records"][1]}) GROUP BY reason""",
    ),
}
