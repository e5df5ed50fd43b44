"""Scalar expressions and payload coding, row by row."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
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
    polarity,
    snapshot_json,
    topic_name,
    with_batch_topic,
    without_spaces,
)
from tally.schemas import POST, REPORT, REPORT_ISSUE

# value, struct is null, id, datetime, issue, re-encoded, corrupt
PAYLOADS = [
    ('{"id":"1","datetime":"d","issue":"COLLISION"}', "1", "d", "COLLISION",
     '{"id":"1","datetime":"d","issue":"COLLISION"}', False),
    ('{"id":2,"issue":null,"x":9}', "2", None, None, '{"id":"2"}', False),
    ("not json", None, None, None, "{}", True),
    (None, None, None, None, "{}", True),
    ("", None, None, None, "{}", True),
    ('{"id":{"a":1},"datetime":[1,2],"issue":true}', '{"a":1}', "[1,2]", "true",
     '{"id":"{\\"a\\":1}","datetime":"[1,2]","issue":"true"}', False),
    ('{"ID":"7"}', None, None, None, "{}", False),
    ('{"id":"1","id":"2"}', "2", None, None, '{"id":"2"}', False),
    ('[{"id":"9","issue":"z"}]', None, None, None, "{}", True),
    ('{"id":"1","issue":"A"', None, None, None, "{}", True),
    ('{"id":"1","_corrupt_record":"zz"}', "1", None, None, '{"id":"1"}', False),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(i, p[0]) for i, p in enumerate(PAYLOADS)]
    return spark.createDataFrame(rows, "i int, text string").select(
        "i", F.col("text").cast("binary").alias("value")
    )


@pytest.mark.parametrize("filtered", [False, True])
def test_decode_fixture_rows(log, filtered):
    got = decode(log, REPORT, ["i"], filtered).orderBy("i").collect()
    assert [(r.id, r.datetime, r.issue) for r in got] == [p[1:4] for p in PAYLOADS]


@pytest.mark.parametrize("filtered", [False, True])
def test_decoding_one_field_gives_the_same_values(log, filtered):
    got = decode(log, REPORT_ISSUE, ["i"], filtered).orderBy("i").collect()
    assert [r.issue for r in got] == [p[3] for p in PAYLOADS]


def test_reencoding_leaves_nulls_out(log):
    records = decode(log, REPORT, ["i"])
    text = json_text("id", "datetime", "issue").alias("text")
    got = records.select("i", text).orderBy("i").collect()
    assert [r.text for r in got] == [p[4] for p in PAYLOADS]


def test_checked_decoding_flags_what_is_no_object(log):
    got = decode_checked(log, REPORT, ["i"]).orderBy("i").collect()
    assert [r.corrupt for r in got] == [p[5] for p in PAYLOADS]
    assert [r.raw for r in got] == [p[0] for p in PAYLOADS]
    assert [(r.id, r.datetime, r.issue) for r in got] == [p[1:4] for p in PAYLOADS]


def test_foreign_json_spacing_and_escapes_decode_alike(spark):
    record = {"id": "é", "sentiment": "0", "hashtag": "#ü\n\"x\""}
    foreign = spark.createDataFrame([(json.dumps(record).encode(),)], "value binary")
    ours = encode(spark.createDataFrame([record], POST), ["id", "sentiment", "hashtag"])
    assert ours.first().value != foreign.first().value
    assert decode(foreign, POST).first() == decode(ours, POST).first()


TEXT = st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=20))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(TEXT, TEXT, TEXT), min_size=1, max_size=20))
def test_decode_inverts_encode(spark, rows):
    records = spark.createDataFrame(rows, REPORT).coalesce(1)
    back = decode(encode(records, ["id", "datetime", "issue"]), REPORT)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, records.collect()))


@pytest.mark.parametrize(
    "text, token, joined",
    [
        ("a b #x", "#x", "ab#x"),
        ("tail ", "", "tail"),
        ("", "", ""),
        ("one", "one", "one"),
        ("a  b", "b", "ab"),
        ("a\nb c\td", "c\td", "a\nbc\td"),
        (None, None, None),
    ],
)
def test_last_token_and_spaces(spark, text, token, joined):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(last_token(F.col("t")), without_spaces(F.col("t"))).first()
    assert tuple(row) == (token, joined)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text("ab \n#", max_size=12), min_size=1, max_size=30))
def test_last_token_is_what_follows_the_last_space(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r.h for r in df.select(last_token(F.col("t")).alias("h")).collect()]
    assert got == [t.split(" ")[-1] for t in texts]


def test_topic_names(spark):
    row = spark.range(1).select(
        topic_name(F.lit("Traffic Hazard")).alias("t"),
        with_batch_topic(topic_name(F.lit("Crash Urgent"))).alias("b"),
    ).first()
    assert tuple(row) == ("TrafficHazard", "CrashUrgent_batch")


def test_polarity_of_other_codes_and_nulls_is_negative(spark):
    df = spark.createDataFrame([("0",), ("1",), ("x",), (None,)], "s string").coalesce(1)
    sides = [r.p for r in df.select(polarity(F.col("s")).alias("p")).collect()]
    assert sides == ["positive", "negative", "negative", "negative"]
    turned = [r.p for r in df.select(polarity(F.col("s"), "1").alias("p")).collect()]
    assert turned == ["negative", "positive", "negative", "negative"]


def test_snapshot_message_round_trip(spark):
    wide = spark.createDataFrame([(1, 0, 7)], "`Crash Urgent` bigint, COLLISION bigint, `a.b` bigint")
    message = wide.select(snapshot_json(["Crash Urgent", "COLLISION", "a.b"]).alias("value"))
    assert message.first().value == '{"Crash Urgent":1,"COLLISION":0,"a.b":7}'
    counts = F.col("counts")
    got = decode_snapshots(message).select(
        count_of(counts, "Crash Urgent"), count_of(counts, "a.b"), count_of(counts, "none")
    ).first()
    assert tuple(got) == (1, 7, 0)


def test_blocks_of_large_ids_are_exact(spark):
    big = 2**62 + 999
    row = spark.range(1).select(block_of(F.lit(big), 1000).alias("b")).first()
    assert row.b == big // 1000
