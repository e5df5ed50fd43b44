"""Files in and out, and the connectors' configuration."""

import csv

import pytest
from pyspark.sql import functions as F

from tally.functions import decode, encode
from tally.operators import post_records, report_records
from tally.plans import inputs
from tally.plans.endpoints import Documents, Files
from tally.plans.publisher import publish_posts, publish_reports
from tally.schemas import ISSUES, POST, POST_TOPIC, REPORT
from tally.session import scratch, state_partitions
from tally.sinks import (
    document_options,
    documents,
    kafka_sink_options,
    publish,
    write_batch,
    write_documents,
)
from tally.sources import (
    bytes_per_trigger,
    delimited_stream,
    delimited_table,
    kafka_options,
    kafka_table,
    latest_batch,
    read_batches,
    topic_stream,
    topic_table,
)
from tally.sources.delimited import split_or_whole
from tally.streaming import finish, start

POSTS_FILE = """ItemID,Sentiment,SentimentText
1,0,a b #x
2,,"q ""z"" y"
3,1,"multi
line end"

4,1
5,1,x,extra
6,1," lead "
"""


def test_delimited_file_edge_cases(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text(POSTS_FILE)
    got = [tuple(r) for r in delimited_table(spark, str(path), multiline=True).collect()]
    assert got == [
        ("1", "0", "a b #x"),
        ("2", None, 'q "z" y'),
        ("3", "1", "multi\nline end"),
        ("4", "1", None),
        ("5", "1", "x"),
        ("6", "1", " lead "),
    ]
    with path.open(newline="") as f:
        plain = [tuple(r[c] for c in ("ItemID", "Sentiment", "SentimentText")) for r in csv.DictReader(f)]
    # An empty field and a missing one are both null here.
    assert [tuple(v or None for v in r) for r in plain] == got


def test_files_are_read_whole_where_fields_hold_line_breaks(spark, tmp_path):
    head = "ItemID,Sentiment,SentimentText\n"
    texts = {
        "a b": head + '1,0,"hello\nworld, #tag"\n2,1,"one ""q"" line"\n',
        "plain": head + '3,1,x y\n4,0,"a, b"\n',
        "long": head + '5,1,"x\ny,z,w\n\nend"\n6,0,last\n',
        "odd": head + '7,0,5" pipe\n8,1,next\n',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    got = post_records(delimited_table(spark, str(tmp_path), multiline=None)).collect()
    assert sorted((r.id, r.sentiment, r.hashtag) for r in got) == [
        ("1", "0", "#tag"), ("2", "1", "line"), ("3", "1", "y"), ("4", "0", "b"),
        ("5", "1", "x\ny,z,w\n\nend"), ("6", "0", "last"), ("7", "0", "pipe"), ("8", "1", "next"),
    ]
    split, whole = split_or_whole(spark, str(tmp_path))
    assert [[f.rsplit("/", 1)[1] for f in files] for files in (split, whole)] == [
        ["plain.csv"], ["a b.csv", "long.csv", "odd.csv"],
    ]
    assert delimited_table(spark, str(tmp_path / "plain.csv"), multiline=None).count() == 2
    with pytest.raises(ValueError, match="over 10 bytes"):
        delimited_table(spark, str(tmp_path), multiline=None, most_bytes=10)


def test_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Issue Reported,Address,Traffic Report ID,Published Date\nCOLLISION,\"x, y\",7,d\n"
    )
    rows = delimited_table(spark, str(tmp_path))
    assert [tuple(r) for r in report_records(rows).collect()] == [("7", "d", "COLLISION")]


def test_a_file_with_other_columns_is_not_read_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited_table(spark, str(tmp_path), ["A", "B"]).collect()


def test_texts_survive_a_delimited_file(spark, tmp_path):
    texts = ["", " a ", 'say "x", y', "back\\slash\\", "line\nbreak\r\nand\rmore", "tab\t", "\\\"", "é"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")
    inputs.write_delimited(rows, str(tmp_path / "out"))
    back = delimited_table(spark, str(tmp_path / "out"), multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_delimited_stream_reads_arriving_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query_files = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    for i in range(2):
        (tmp_path / "in" / f"{i}.csv").write_text(f"A,B\n{i},x\n")
        rows = delimited_stream(spark, str(tmp_path / "in"))
        finish(start(rows, query_files[1], path=query_files[0], once=True))
    assert sorted(map(tuple, spark.read.parquet(query_files[0]).collect())) == [("0", "x"), ("1", "x")]


def report_rows(spark):
    schema = "`Traffic Report ID` string, `Published Date` string, `Issue Reported` string, Other string"
    rows = [("1", "d", "Traffic Hazard", "-"), ("2", "d", "COLLISION", "-"), ("3", "d", "Stalled", "-")]
    return spark.createDataFrame(rows, schema)


def test_publisher_writes_both_topic_families(spark, tmp_path):
    out = Files(str(tmp_path / "topics"))
    publish_reports(report_rows(spark), out)
    folders = sorted(p.name for p in (tmp_path / "topics").glob("run=*/batch_id=*/topic=*"))
    assert folders == [
        "topic=COLLISION", "topic=COLLISION_batch", "topic=TrafficHazard", "topic=TrafficHazard_batch",
    ]
    log = topic_table(spark, out.path, ["TrafficHazard", "COLLISION"])
    assert sorted(map(tuple, decode(log, REPORT).collect())) == [
        ("1", "d", "Traffic Hazard"), ("2", "d", "COLLISION"),
    ]


def test_post_publisher_keeps_all_rows_in_one_topic(spark, tmp_path):
    schema = "ItemID string, Sentiment string, SentimentText string"
    rows = spark.createDataFrame([("1", "0", "a #x"), ("2", "9", "b")], schema)
    publish_posts(rows, Files(str(tmp_path)))
    got = decode(topic_table(spark, str(tmp_path), [POST_TOPIC]), POST).collect()
    assert sorted(map(tuple, got)) == [("1", "0", "#x"), ("2", "9", "b")]


def test_topic_stream_reads_the_named_topics_only(spark, tmp_path):
    path = str(tmp_path / "topics")
    rows = [(f"{t}-{i}".encode(), t) for t in ("A", "A_batch", "B", "C") for i in range(3)]
    publish(spark.createDataFrame(rows, "value binary, topic string"), path)
    got = topic_stream(spark, path, ["A", "C"])
    finish(start(got, str(tmp_path / "checkpoint"), path=str(tmp_path / "out"), once=True))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.topic, bytes(r.value).decode()) for r in back.collect()} == {
        (t, f"{t}-{i}") for t in "AC" for i in range(3)
    }
    with pytest.raises(ValueError):
        topic_stream(spark, path, ["A}/../x"])


def test_places_of_file_records_are_unique(spark, tmp_path):
    path = str(tmp_path / "topics")
    rows = [(b"x", t) for t in ("A", "B") for _ in range(5)]
    publish(spark.createDataFrame(rows, "value binary, topic string"), path)
    log = Files(path).stream(spark, ["A", "B"])
    finish(start(log, str(tmp_path / "checkpoint"), path=str(tmp_path / "out"), once=True))
    back = spark.read.parquet(str(tmp_path / "out"))
    keyed = documents(back, Files.lineage)
    assert keyed.columns == ["_id", "value"]
    assert keyed.count() == keyed.select("_id").distinct().count() == 10


def test_bytes_per_trigger_cuts_a_folder(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"f{i}").write_bytes(b"x" * 100)
    assert bytes_per_trigger(spark, str(tmp_path), 4) == 100
    assert bytes_per_trigger(spark, str(tmp_path), 3) == 134


def test_a_repeated_batch_replaces_its_own_output(spark, tmp_path):
    path = str(tmp_path)
    for batch_id, n in [(0, 3), (1, 2), (1, 2), (0, 3)]:
        write_batch(spark.range(n), path, batch_id)
    back = read_batches(spark, path, "id bigint")
    assert {r.batch_id: r["count"] for r in back.groupBy("batch_id").count().collect()} == {0: 3, 1: 2}
    assert sorted(r.id for r in latest_batch(back).collect()) == [0, 1]


def test_documents_are_written_per_batch(spark, tmp_path):
    write_documents(spark.range(2), 5, path=str(tmp_path))
    Documents(path=str(tmp_path)).writer()(spark.range(1), 6)
    back = spark.read.json(str(tmp_path))
    assert sorted(map(tuple, back.select("batch_id", "id").collect())) == [(5, 0), (5, 1), (6, 0)]
    with pytest.raises(ValueError):
        write_documents(spark.range(2), 5)


def test_document_options_replace_by_key():
    options = document_options("mongodb://host", "db", "records")
    assert options["operationType"] == "replace" and options["idFieldList"] == "_id"


def test_kafka_reader_options():
    options = kafka_options("h:1", ["A", "B"], "latest", fail_on_data_loss=False, max_offsets=10)
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "A,B",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
    }
    assert kafka_options("h:1", ["A"])["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_options("h:1", ["A"], "yesterday")
    with pytest.raises(ValueError):
        kafka_options("h:1", [])


def test_kafka_batch_read_cannot_start_at_the_end(spark):
    with pytest.raises(ValueError):
        kafka_table(spark, kafka_options("h:1", ["A"], "latest"))


def test_kafka_sink_options():
    assert kafka_sink_options("h:1") == {"kafka.bootstrap.servers": "h:1"}
    assert kafka_sink_options("h:1", "output")["topic"] == "output"


def test_scratch_folders_are_new_and_below_the_checkpoint_dir(spark):
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert first.startswith(root)


def test_state_partitions_are_set_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 2):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    with pytest.raises(RuntimeError), state_partitions(spark, 3):
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_published_payload_is_utf8_json(spark):
    df = spark.createDataFrame([("1", None, "COLLISION")], REPORT)
    assert bytes(encode(df, ["id", "datetime", "issue"]).first().value) == b'{"id":"1","issue":"COLLISION"}'


def test_topics_of_all_labels_are_valid_names(spark):
    from tally.plans.reports import topics_of

    assert topics_of(ISSUES) == ["TrafficHazard", "CrashUrgent", "CrashService", "COLLISION"]
    df = spark.createDataFrame([(i,) for i in ISSUES], "issue string").coalesce(1)
    named = df.select(F.replace("issue", F.lit(" "), F.lit("")).alias("t"))
    assert [r.t for r in named.collect()] == topics_of(ISSUES)
