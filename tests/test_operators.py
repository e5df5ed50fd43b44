"""Batch operators on small tables, against Python."""

from collections import Counter
from itertools import accumulate as running

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tally.functions import decode_checked, decode_snapshots, encode
from tally.operators import (
    accumulate,
    add_up,
    batch_document,
    count_by,
    event_windows,
    label_counts,
    label_rows,
    post_records,
    prefix_sums,
    processing_windows,
    quarantine,
    report_records,
    route,
    share_of_total,
    tag_batch,
    tracked,
    window_rows,
    zero_fill,
)
from tally.schemas import ISSUES, REPORT

SPARK_TEST = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def issues(spark, values):
    return spark.createDataFrame([(v,) for v in values], "issue string")


def as_dict(df, key="issue", n="n"):
    return {r[key]: r[n] for r in df.collect()}


def test_tracked_is_exact_and_case_sensitive(spark):
    df = issues(spark, ["COLLISION", "collision", "Crash Urgent", "CrashUrgent", " COLLISION", None])
    assert sorted(r.issue for r in tracked(df).collect()) == ["COLLISION", "Crash Urgent"]


def test_report_records_take_three_columns_as_text(spark):
    schema = "`Traffic Report ID` bigint, Extra string, `Published Date` string, `Issue Reported` string"
    rows = spark.createDataFrame([(7, "x", "d", "COLLISION"), (8, "y", None, None)], schema)
    records = report_records(rows)
    assert records.schema.simpleString() == "struct<id:string,datetime:string,issue:string>"
    assert [tuple(r) for r in records.collect()] == [("7", "d", "COLLISION"), ("8", None, None)]


def test_post_records(spark):
    schema = "ItemID string, Sentiment string, SentimentText string"
    rows = spark.createDataFrame([("1", "0", "a b #x"), ("2", None, None)], schema)
    assert [tuple(r) for r in post_records(rows).collect()] == [("1", "0", "#x"), ("2", None, None)]


def test_routes(spark):
    df = issues(spark, ["Traffic Hazard"])
    topics = {to: [r.topic for r in route(df, to=to).collect()] for to in ("stream", "batch", "both")}
    assert topics == {
        "stream": ["TrafficHazard"],
        "batch": ["TrafficHazard_batch"],
        "both": ["TrafficHazard", "TrafficHazard_batch"],
    }


def test_quarantine_and_tracked_split_the_log(spark):
    payloads = ['{"id":"1","issue":"COLLISION"}', '{"id":"2","issue":"Other"}', '{"id":"3"}', "x", "", None]
    payloads += ['{"id":"6","issue":"COLLISION"}{"id":"7"}', '{"id":"8","issue":"COLLISION"} on', ' {"id":"9","issue":"COLLISION"} ']
    log = spark.createDataFrame([(p,) for p in payloads], "t string").select(
        F.col("t").cast("binary").alias("value")
    )
    checked = decode_checked(log, REPORT)
    kept = [r.id for r in tracked(checked).collect()]
    reasons = Counter(r.reason for r in quarantine(checked).collect())
    assert sorted(kept) == ["1", "6", "8", "9"]
    assert reasons == {"unknown category": 1, "no category": 1, "undecodable": 3, "more than one object": 2}


@SPARK_TEST
@given(values=st.lists(st.sampled_from([*ISSUES, "Other", None]), max_size=40))
def test_counts_and_documents_hold_every_row(spark, values):
    df = issues(spark, values).coalesce(1)
    assert as_dict(count_by(df, "issue")) == Counter(values)
    documents = batch_document(tag_batch(df, 3), ISSUES, other="other").collect()
    assert len(documents) == (1 if values else 0)
    for row in documents:
        expected = Counter(v if v in ISSUES else "other" for v in values)
        assert row.batch_id == 3
        assert {k: row[k] for k in (*ISSUES, "other")} == {k: expected[k] for k in (*ISSUES, "other")}


def test_zero_fill_of_nothing_is_all_zeros(spark):
    counts = count_by(issues(spark, []), "issue")
    assert as_dict(zero_fill(counts)) == dict.fromkeys(ISSUES, 0)


def test_zero_fill_drops_other_labels(spark):
    counts = count_by(issues(spark, ["COLLISION", "COLLISION", "Other", None]), "issue")
    assert as_dict(zero_fill(counts)) == {**dict.fromkeys(ISSUES, 0), "COLLISION": 2}


def test_label_counts_and_back(spark):
    counts = spark.createDataFrame([("COLLISION", 5), ("Other", 9)], "issue string, n bigint")
    wide = label_counts(counts, ISSUES, "issue")
    assert wide.columns == list(ISSUES)
    assert as_dict(label_rows(wide, ISSUES)) == {**dict.fromkeys(ISSUES, 0), "COLLISION": 5}


@SPARK_TEST
@given(ns=st.lists(st.integers(0, 10**12), min_size=1, max_size=6))
def test_shares_sum_to_a_hundred(spark, ns):
    counts = spark.createDataFrame([(str(i), n) for i, n in enumerate(ns)], "issue string, n bigint")
    shares = [r.share for r in share_of_total(counts.coalesce(1)).collect()]
    if sum(ns) == 0:
        assert shares == [None] * len(ns)
    else:
        assert sum(shares) == pytest.approx(100, abs=0.005 * len(ns) + 1e-9)


def test_running_and_compounding_totals_of_three_batches(spark):
    rows = [(b, v) for b, batch in enumerate(["ABA", "ABBB", "A"]) for v in batch]
    batches = batch_document(spark.createDataFrame(rows, "batch_id bigint, issue string"), ["A", "B"])
    running_ = prefix_sums(batches, ["A", "B"])
    compounded = prefix_sums(running_, ["A", "B"])
    assert sorted(map(tuple, running_.collect())) == [(0, 2, 1), (1, 3, 4), (2, 4, 4)]
    assert sorted(map(tuple, compounded.collect())) == [(0, 2, 1), (1, 5, 5), (2, 9, 9)]


@SPARK_TEST
@given(
    history=st.dictionaries(st.integers(0, 200), st.tuples(st.integers(0, 99), st.integers(0, 99)), min_size=1),
    block=st.sampled_from([1, 2, 7, 64, 1000]),
)
def test_prefix_sums_for_any_block_width(spark, history, block):
    rows = [(b, *v) for b, v in history.items()]
    df = spark.createDataFrame(rows, "batch_id bigint, `a b` bigint, c bigint").coalesce(1)
    got = sorted(map(tuple, prefix_sums(df, ["a b", "c"], block=block).collect()))
    ids = sorted(history)
    sums = running((history[i] for i in ids), lambda x, y: (x[0] + y[0], x[1] + y[1]))
    assert got == [(i, *s) for i, s in zip(ids, sums)]


def test_accumulate_adds_cumulative_snapshots(spark):
    messages = ['{"COLLISION":1,"Crash Urgent":2}', '{"COLLISION":4,"Other":8}']
    log = spark.createDataFrame([(m,) for m in messages], "value string")
    sums = accumulate(decode_snapshots(log))
    assert as_dict(sums) == {**dict.fromkeys(ISSUES, 0), "COLLISION": 5, "Crash Urgent": 2}


WINDOW_ROWS = [
    ("2024-01-01 00:00:00", "A"),
    ("2024-01-01 00:00:09.999999", "A"),
    ("2024-01-01 00:00:10", "A"),
    ("2024-01-01 00:00:10", "B"),
    (None, "A"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_event_windows_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(WINDOW_ROWS, "t string, issue string")
        timed = df.select(F.col("t").try_cast("timestamp_ntz").alias("ts"), "issue")
        counts = window_rows(event_windows(timed))
        got = sorted((str(r.window_start), str(r.window_end), r.issue, r.n) for r in counts.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "A", 2),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "A", 1),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "B", 1),
    ]


def test_processing_windows_put_a_table_in_one_window(spark):
    counts = processing_windows(issues(spark, ["A", "B", "A"]))
    assert as_dict(add_up(counts, "issue"), n="total") == {"A": 2, "B": 1}
    assert counts.select("window").distinct().count() == 1
