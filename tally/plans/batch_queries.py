"""Registered queries over tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import (
    block_of,
    count_of,
    decode,
    decode_checked,
    decode_snapshots,
    encode,
    json_text,
    last_token,
    snapshot_json,
)
from tally.operators import (
    accumulate,
    add_up,
    batch_document,
    count_by,
    event_windows,
    label_rows,
    prefix_sums,
    post_records,
    quarantine,
    report_records,
    route,
    share_of_total,
    tracked,
    window_rows,
    zero_fill,
)
from tally.plans import inputs
from tally.plans.inputs import TRACKED, UNSEEN, UNTRACKED
from tally.plans.posts import SENTIMENTS, polarity_totals
from tally.schemas import POST, POST_COLUMNS, REPORT, REPORT_ISSUE
from tally.session import scratch
from tally.sinks import publish
from tally.sources import delimited_table, topic_table

REPORT_FIELDS = ["id", "datetime", "issue"]

TRACKED_SQL = "('click', 'error', 'purchase', 'signup')"

REPORTS_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS id, CAST(ts AS VARCHAR) AS datetime, event_type AS issue
    FROM events"""

POSTS_SQL = """
    SELECT CAST(d.doc_id AS VARCHAR) AS id, CAST(l.toxic AS VARCHAR) AS sentiment,
           string_split(d.text, ' ')[-1] AS hashtag
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

WINDOWS_SQL = """
    SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start,
           time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end,
           event_type AS issue, count(*) AS n
    FROM events GROUP BY ALL"""

# Running totals of the tracked types after each batch of 1000 event ids, one row per batch.
RUNNING_SQL = """
    WITH batches AS (
        SELECT event_id // 1000 AS batch_id,
               count(*) FILTER (WHERE event_type = 'click') AS click,
               count(*) FILTER (WHERE event_type = 'error') AS error,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
               count(*) FILTER (WHERE event_type = 'signup') AS signup
        FROM events GROUP BY 1),
    running AS (
        SELECT batch_id,
               CAST(sum(click) OVER w AS BIGINT) AS click,
               CAST(sum(error) OVER w AS BIGINT) AS error,
               CAST(sum(purchase) OVER w AS BIGINT) AS purchase,
               CAST(sum(signup) OVER w AS BIGINT) AS signup
        FROM batches WINDOW w AS (ORDER BY batch_id)),
    compounded AS (
        SELECT batch_id,
               CAST(sum(click) OVER w AS BIGINT) AS click,
               CAST(sum(error) OVER w AS BIGINT) AS error,
               CAST(sum(purchase) OVER w AS BIGINT) AS purchase,
               CAST(sum(signup) OVER w AS BIGINT) AS signup
        FROM running WINDOW w AS (ORDER BY batch_id))"""


def long_sql(name: str) -> str:
    return f"""{RUNNING_SQL}
    SELECT batch_id, issue, n FROM {name}
    UNPIVOT (n FOR issue IN (click, error, purchase, signup))"""


# ---- payloads and records


def decode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = encode(inputs.reports(spark, sf_dir), REPORT_FIELDS)
    return decode(log, REPORT).select("id", "datetime", "issue")


def decode_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = encode(inputs.posts(spark, sf_dir), ["id", "sentiment", "hashtag"])
    return decode(log, POST)


def encode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tracked(inputs.reports(spark, sf_dir), TRACKED)
    return records.select("id", json_text().alias("value"))


def encode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = encode(tracked(inputs.reports(spark, sf_dir), TRACKED), REPORT_FIELDS, ["id"])
    return log.select("id", F.md5("value").alias("digest"), F.octet_length("value").alias("bytes"))


def filter_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracked(inputs.reports(spark, sf_dir), TRACKED)


def quarantine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decode_checked(inputs.mixed_log(spark, sf_dir), REPORT, keep=["origin"])
    return quarantine(checked, TRACKED).select("origin", "raw", "id", "issue", "reason")


# ---- routing


def _priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"id": "o_orderkey", "datetime": "o_orderdate", "issue": "o_orderpriority"}
    return report_records(inputs.table(spark, sf_dir, "orders"), names)


def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_priorities(spark, sf_dir)).select("id", "issue", "topic")


def topic_route_batch_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_priorities(spark, sf_dir), to="batch").select("id", "issue", "topic")


def last_token_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", last_token(F.col("text")).alias("hashtag"))


# ---- counts


def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(inputs.posts(spark, sf_dir), "sentiment")


def polarity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polarity_totals(inputs.posts(spark, sf_dir))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(inputs.batched_reports(spark, sf_dir), "batch_id", "issue")


def batch_count_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_document(inputs.batched_reports(spark, sf_dir), TRACKED)


def sentiment_batch_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = block_of(F.col("doc_id"), inputs.DOCUMENTS_PER_BATCH).alias("batch_id")
    labels = inputs.labelled(spark, sf_dir)
    codes = labels.select(batch, F.col("toxic").cast("string").alias("sentiment"))
    return batch_document(codes, SENTIMENTS, "sentiment", other="other")


def zero_filled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_by(inputs.reports(spark, sf_dir), "issue")
    return zero_fill(counts, [*TRACKED, UNSEEN])


def share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: events through the payload coding to each category's share of the total."""
    log = encode(inputs.reports(spark, sf_dir), REPORT_FIELDS)
    counts = count_by(tracked(decode(log, REPORT_ISSUE, filtered=True), TRACKED), "issue")
    return share_of_total(zero_fill(counts, TRACKED))


# ---- windows


def window_counts_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return window_rows(event_windows(events.withColumnRenamed("event_type", "issue")))


def windowed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_up(window_counts_10s(spark, sf_dir), "issue")


def windowed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = window_counts_10s(spark, sf_dir)
    bounds = [
        F.date_format(f"window_{end}", "yyyy-MM-dd HH:mm:ss").alias(end) for end in ("start", "end")
    ]
    nested = counts.select(F.struct(*bounds).alias("window"), "issue", "n")
    return nested.select(json_text().alias("value"))


# ---- histories of totals


def _running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_sums(batch_count_document(spark, sf_dir), TRACKED)


def _messages(running: DataFrame) -> DataFrame:
    return running.select("batch_id", snapshot_json(TRACKED).alias("value"))


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_rows(_running(spark, sf_dir), TRACKED, ["batch_id"])


def snapshot_prefix_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_rows(prefix_sums(_running(spark, sf_dir), TRACKED), TRACKED, ["batch_id"])


def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(_running(spark, sf_dir))


def snapshot_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = decode_snapshots(_messages(_running(spark, sf_dir)))
    return accumulate(received, TRACKED)


def snapshot_accumulate_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    compounded = prefix_sums(_running(spark, sf_dir), TRACKED)
    return accumulate(decode_snapshots(_messages(compounded)), TRACKED)


def snapshot_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = decode_snapshots(_messages(_running(spark, sf_dir)), keep=["batch_id"])
    counts = F.col("counts")
    return received.select(
        "batch_id",
        count_of(counts, "click").alias("click"),
        count_of(counts, UNTRACKED).alias("view"),
    )


# ---- sources


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    inputs.write_delimited(inputs.report_rows(spark, sf_dir), path)
    return tracked(report_records(delimited_table(spark, path)), TRACKED)


def csv_scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    inputs.write_delimited(inputs.post_rows(spark, sf_dir), path)
    return post_records(delimited_table(spark, path, multiline=True))


def csv_scan_as_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with and without line breaks in their fields, each read as it needs."""
    path, posts = scratch(spark, "csv"), inputs.post_rows(spark, sf_dir)
    broken = F.col(POST_COLUMNS["text"]).contains("\n")
    inputs.write_delimited(posts.filter(broken), f"{path}/a")
    inputs.write_delimited(posts.filter(~broken), f"{path}/b")
    return post_records(delimited_table(spark, [f"{path}/a", f"{path}/b"], multiline=None))


def multi_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "topics")
    publish(inputs.report_log(spark, sf_dir), path)
    return count_by(decode(topic_table(spark, path, TRACKED), REPORT), "issue")


QUERIES = {
    "share_of_total": (
        share,
        f"""
    WITH c AS (SELECT event_type AS issue, count(*) AS n FROM events
               WHERE event_type IN {TRACKED_SQL} GROUP BY 1)
    SELECT issue, n, round(100.0 * n / sum(n) OVER (), 2) AS share FROM c""",
    ),
    "decode_records": (decode_records, REPORTS_SQL),
    "decode_star": (decode_star, POSTS_SQL),
    "encode_records": (
        encode_records,
        f"""
    SELECT CAST(event_id AS VARCHAR) AS id,
           CAST(json_object('id', CAST(event_id AS VARCHAR), 'datetime', CAST(ts AS VARCHAR),
                            'issue', event_type) AS VARCHAR) AS value
    FROM events WHERE event_type IN {TRACKED_SQL}""",
    ),
    "encode_payloads": (
        encode_payloads,
        f"""
    WITH p AS (
        SELECT CAST(event_id AS VARCHAR) AS id,
               CAST(json_object('id', CAST(event_id AS VARCHAR), 'datetime', CAST(ts AS VARCHAR),
                                'issue', event_type) AS VARCHAR) AS value
        FROM events WHERE event_type IN {TRACKED_SQL})
    SELECT id, md5(value) AS digest, CAST(strlen(value) AS INTEGER) AS bytes FROM p""",
    ),
    "filter_tracked": (filter_tracked, f"{REPORTS_SQL} WHERE event_type IN {TRACKED_SQL}"),
    "quarantine_records": (
        quarantine_records,
        f"""
    SELECT 'reports' AS origin,
           CAST(json_object('id', CAST(event_id AS VARCHAR), 'datetime', CAST(ts AS VARCHAR),
                            'issue', event_type) AS VARCHAR) AS raw,
           CAST(event_id AS VARCHAR) AS id, event_type AS issue, 'unknown category' AS reason
    FROM events WHERE event_type NOT IN {TRACKED_SQL}
    UNION ALL
    SELECT 'props', props, NULL, NULL, 'no category' FROM events
    UNION ALL
    SELECT 'texts', text, NULL, NULL, 'undecodable' FROM documents""",
    ),
    "topic_route": (
        topic_route,
        """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS issue,
           replace(o_orderpriority, ' ', '') || s.suffix AS topic
    FROM orders CROSS JOIN (VALUES (''), ('_batch')) AS s(suffix)""",
    ),
    "topic_route_batch_only": (
        topic_route_batch_only,
        """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS issue,
           replace(o_orderpriority, ' ', '') || '_batch' AS topic
    FROM orders""",
    ),
    "last_token": (
        last_token_of_text,
        "SELECT doc_id, string_split(text, ' ')[-1] AS hashtag FROM documents",
    ),
    "sentiment_counts": (
        sentiment_counts,
        f"SELECT sentiment, count(*) AS n FROM ({POSTS_SQL}) GROUP BY 1",
    ),
    "polarity_totals": (
        polarity_counts,
        f"""
    SELECT CASE WHEN sentiment = '0' THEN 'positive' ELSE 'negative' END AS polarity,
           count(*) AS n
    FROM ({POSTS_SQL}) GROUP BY 1""",
    ),
    "batch_counts": (
        batch_counts,
        """
    SELECT event_id // 1000 AS batch_id, event_type AS issue, count(*) AS n
    FROM events GROUP BY 1, 2""",
    ),
    "batch_count_document": (
        batch_count_document,
        f"{RUNNING_SQL} SELECT batch_id, click, error, purchase, signup FROM batches",
    ),
    "sentiment_batch_document": (
        sentiment_batch_document,
        """
    SELECT d.doc_id // 100 AS batch_id,
           count(*) FILTER (WHERE toxic = 0) AS "0",
           count(*) FILTER (WHERE toxic = 1) AS "1",
           count(*) FILTER (WHERE toxic IS NULL OR toxic NOT IN (0, 1)) AS other
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    ),
    "zero_filled_counts": (
        zero_filled_counts,
        """
    SELECT d.issue, count(e.event_id) AS n
    FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('refund')) AS d(issue)
    LEFT JOIN events e ON e.event_type = d.issue GROUP BY 1""",
    ),
    "window_counts_10s": (window_counts_10s, WINDOWS_SQL),
    "windowed_total": (
        windowed_total,
        f"SELECT issue, CAST(sum(n) AS BIGINT) AS total FROM ({WINDOWS_SQL}) GROUP BY 1",
    ),
    "windowed_json": (
        windowed_json,
        f"""
    SELECT CAST(json_object(
               'window', json_object('start', strftime(window_start, '%Y-%m-%d %H:%M:%S'),
                                     'end', strftime(window_end, '%Y-%m-%d %H:%M:%S')),
               'issue', issue, 'n', n) AS VARCHAR) AS value
    FROM ({WINDOWS_SQL})""",
    ),
    "running_totals": (running_totals, long_sql("running")),
    "snapshot_prefix_sum": (snapshot_prefix_sum, long_sql("compounded")),
    "snapshot_publish": (
        snapshot_publish,
        f"""{RUNNING_SQL}
    SELECT batch_id,
           CAST(json_object('click', click, 'error', error, 'purchase', purchase,
                            'signup', signup) AS VARCHAR) AS value
    FROM running""",
    ),
    "snapshot_accumulate": (
        snapshot_accumulate,
        f"SELECT issue, CAST(sum(n) AS BIGINT) AS n FROM ({long_sql('running')}) GROUP BY 1",
    ),
    "snapshot_accumulate_windowed": (
        snapshot_accumulate_windowed,
        f"SELECT issue, CAST(sum(n) AS BIGINT) AS n FROM ({long_sql('compounded')}) GROUP BY 1",
    ),
    "snapshot_lookup": (
        snapshot_lookup,
        f"""{RUNNING_SQL} SELECT batch_id, click, CAST(0 AS BIGINT) AS "view" FROM running""",
    ),
    "csv_scan": (csv_scan, f"{REPORTS_SQL} WHERE event_type IN {TRACKED_SQL}"),
    "csv_scan_multiline": (csv_scan_multiline, POSTS_SQL),
    "csv_scan_as_needed": (csv_scan_as_needed, POSTS_SQL),
    "multi_source_union": (
        multi_source_union,
        f"""
    SELECT event_type AS issue, count(*) AS n FROM events
    WHERE event_type IN {TRACKED_SQL} GROUP BY 1""",
    ),
}
