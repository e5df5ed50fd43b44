"""Streaming queries over several batches, restarts and repeats."""

import json

import pytest
from pyspark.sql import functions as F

from tally.functions import decode, decode_snapshots, encode
from tally.operators import (
    accumulate,
    add_up,
    count_by,
    event_windows,
    label_counts,
    prefix_sums,
    tracked,
    window_rows,
)
from tally.plans.endpoints import Documents, Files
from tally.plans.posts import start_posts
from tally.plans.reports import record_outputs, start_reports, topics_of
from tally.plans.windows import start_window_table, start_windows
from tally.schemas import (
    ISSUES,
    POST,
    POST_TOPIC,
    REPORT,
    REPUBLISH_TOPIC,
    TOTALS_TOPIC,
    WINDOW_TOTALS_TOPIC,
)
from tally.session import ROCKSDB_PROVIDER
from tally.sinks import publish, write_batch
from tally.sources import file_stream, read_batches, topic_batches
from tally.streaming import (
    ProgressLog,
    fan_out,
    finish,
    latest_totals,
    running_totals,
    snapshot_sink,
    start,
    to_folder,
    window_snapshot_sink,
)

BATCHES = ["ABA", "ABBB", "A"]
LABELS = ["A", "B"]


def add_batch(spark, folder, values):
    """One more file with a report per character of ``values``."""
    rows = [(str(i), "2024-01-01 00:00:00", v) for i, v in enumerate(values)]
    records = spark.createDataFrame(rows, REPORT).coalesce(1)
    encode(records, ["id", "datetime", "issue"]).write.mode("append").parquet(folder)


def read(spark, folder):
    return decode(file_stream(spark, folder, "value binary"), REPORT)


def snapshots_of(spark, path, topic=None):
    history = read_batches(spark, path, "value string") if topic is None else topic_batches(spark, path, topic)
    rows = history.orderBy("run", "batch_id").collect()
    return [(r.batch_id, json.loads(r.value)) for r in rows]


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("log", "checkpoint", "out", "out2")}


def run_batches(spark, folders, query, batches=BATCHES):
    """Deliver one file per run, so that every batch is also a restart from the checkpoint."""
    for values in batches:
        add_batch(spark, folders["log"], values)
        finish(query(read(spark, folders["log"])))


def totals_query(folders, labels=LABELS):
    return lambda records: start(
        running_totals(records, labels),
        folders["checkpoint"],
        snapshot_sink(to_folder(folders["out"]), labels),
        mode="complete",
        once=True,
        state_width=len(labels),
    )


def test_running_totals_survive_restarts(spark, folders):
    run_batches(spark, folders, totals_query(folders))
    assert snapshots_of(spark, folders["out"]) == [
        (0, {"A": 2, "B": 1}),
        (1, {"A": 3, "B": 4}),
        (2, {"A": 4, "B": 4}),
    ]


def test_snapshots_hold_zeros_and_unknown_labels_do_no_harm(spark, folders):
    query = totals_query(folders, ["A", "B", "C"])
    run_batches(spark, folders, query, ["AXA", "X"])
    assert snapshots_of(spark, folders["out"]) == [
        (0, {"A": 2, "B": 0, "C": 0}),
        (1, {"A": 2, "B": 0, "C": 0}),
    ]


def test_totals_do_not_depend_on_the_cut_into_batches(spark, folders, tmp_path):
    values = "".join(BATCHES)
    for i, cut in enumerate([[values], [values[:1], values[1:]], list(values[:4]) + [values[4:]]]):
        own = {k: f"{v}-{i}" for k, v in folders.items()}
        run_batches(spark, own, totals_query(own), cut)
        newest = latest_totals(read_batches(spark, own["out"], "value string"))
        assert {r.issue: r.n for r in newest.collect()} == {"A": 4, "B": 4}


def test_state_has_no_more_partitions_than_categories(spark, folders):
    add_batch(spark, folders["log"], "AB")
    query = totals_query(folders)(read(spark, folders["log"]))
    finish(query)
    states = [s for p in query.recentProgress for s in p.stateOperators]
    assert states and all(s.numShufflePartitions == 2 for s in states)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_several_files_make_several_batches(spark, folders):
    for values in BATCHES:
        add_batch(spark, folders["log"], values)
    log = file_stream(spark, folders["log"], "value binary", max_bytes=1)
    query = totals_query(folders)(decode(log, REPORT))
    finish(query)
    history = snapshots_of(spark, folders["out"])
    assert [b for b, _ in history] == [0, 1, 2]
    assert history[-1][1] == {"A": 4, "B": 4}


def test_update_mode_gives_changed_categories_only(spark, folders):
    query = lambda records: start(
        running_totals(records, LABELS),
        folders["checkpoint"],
        to_folder(folders["out"]),
        mode="update",
        once=True,
        state_width=2,
    )
    run_batches(spark, folders, query)
    rows = read_batches(spark, folders["out"], "issue string, n bigint").collect()
    assert sorted((r.batch_id, r.issue, r.n) for r in rows) == [
        (0, "A", 2), (0, "B", 1), (1, "A", 3), (1, "B", 4), (2, "A", 4),
    ]


def test_append_equals_update_without_aggregation(spark, folders):
    add_batch(spark, folders["log"], "ABAX")
    for mode in ("append", "update"):
        finish(
            start(
                tracked(read(spark, folders["log"]), LABELS),
                f"{folders['checkpoint']}-{mode}",
                to_folder(f"{folders['out']}-{mode}"),
                mode=mode,
                once=True,
            )
        )
    first, second = (
        sorted(map(tuple, spark.read.parquet(f"{folders['out']}-{m}").collect()))
        for m in ("append", "update")
    )
    assert first == second and len(first) == 3


def test_stored_snapshots_give_the_compounding_totals(spark, folders):
    """What a callback that adds complete results again and again would arrive at."""
    sink = window_snapshot_sink(None, to_folder(folders["out"]), LABELS)
    query = lambda records: start(
        event_windows(records.withColumn("ts", F.col("datetime").try_cast("timestamp"))),
        folders["checkpoint"],
        sink,
        mode="complete",
        once=True,
    )
    run_batches(spark, folders, query)
    history = read_batches(spark, folders["out"], "value string")
    counts = decode_snapshots(history, ["batch_id"])
    wide = counts.select("batch_id", *[F.col("counts")[v].alias(v) for v in LABELS])
    assert sorted(map(tuple, wide.collect())) == [(0, 2, 1), (1, 3, 4), (2, 4, 4)]
    assert sorted(map(tuple, prefix_sums(wide, LABELS).collect())) == [
        (0, 2, 1), (1, 5, 5), (2, 9, 9),
    ]
    assert {r.issue: r.n for r in accumulate(counts, LABELS).collect()} == {"A": 9, "B": 9}


def test_watermarked_windows_are_held_back_until_they_are_over(spark, folders):
    times = ["2024-01-01 00:00:01", "2024-01-01 00:00:12", "2024-01-01 00:01:00"]
    for t in times:
        row = spark.createDataFrame([("1", t, "A")], REPORT).coalesce(1)
        encode(row, ["id", "datetime", "issue"]).write.mode("append").parquet(folders["log"])
    log = file_stream(spark, folders["log"], "value binary", max_bytes=1)
    timed = decode(log, REPORT).withColumn("ts", F.col("datetime").try_cast("timestamp_ntz"))
    counts = window_rows(event_windows(timed, delay="10 seconds"))
    finish(start(counts, folders["checkpoint"], path=folders["out"], once=True))
    rows = spark.read.parquet(folders["out"]).collect()
    assert sorted(str(r.window_start) for r in rows) == ["2024-01-01 00:00:00", "2024-01-01 00:00:10"]


def test_rocksdb_keeps_the_state(spark, folders):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB_PROVIDER
    add_batch(spark, folders["log"], "AB")
    query = totals_query(folders)(read(spark, folders["log"]))
    finish(query)
    metrics = query.lastProgress.stateOperators[0].customMetrics
    assert any(m.startswith("rocksdb") for m in metrics)


def test_fan_out_writes_every_output_and_repeats_change_nothing(spark, folders):
    payloads = ['{"id":"1","issue":"A"}', '{"id":"2","issue":"X"}', "junk"]
    batch = spark.createDataFrame([(p,) for p in payloads], "t string")
    from tally.functions import decode_checked

    checked = decode_checked(batch.select(F.col("t").cast("binary").alias("value")), REPORT)
    sink = fan_out(
        record_outputs(
            to_folder(f"{folders['out']}/records"),
            to_folder(f"{folders['out']}/republished"),
            to_folder(f"{folders['out']}/rejected"),
            labels=LABELS,
        )
    )
    for _ in range(2):
        sink(checked, 7)
    counts = {
        part: spark.read.parquet(f"{folders['out']}/{part}").count()
        for part in ("records", "republished", "rejected")
    }
    assert counts == {"records": 1, "republished": 1, "rejected": 2}


def test_a_failing_output_fails_the_query_and_the_next_run_repeats_the_batch(spark, folders):
    add_batch(spark, folders["log"], "AB")
    broken = {"yes": True}

    def fail_once(df, batch_id):
        if broken.pop("yes", False):
            raise RuntimeError("disk full")
        write_batch(df, folders["out2"], batch_id)

    def query():
        outputs = {
            "first": (lambda b: b, to_folder(folders["out"])),
            "second": (lambda b: b, fail_once),
        }
        return start(read(spark, folders["log"]), folders["checkpoint"], fan_out(outputs), once=True)

    with pytest.raises(Exception, match="disk full"):
        finish(query())
    finish(query())
    assert spark.read.parquet(folders["out"]).count() == 2
    assert spark.read.parquet(folders["out2"]).count() == 2


# ---- whole jobs


def publish_values(spark, path, values, topic_of=lambda v: v.replace(" ", "")):
    rows = [(json.dumps({"id": str(i), "datetime": "d", "issue": v}).encode(), topic_of(v))
            for i, v in enumerate(values)]
    publish(spark.createDataFrame(rows, "value binary, topic string").coalesce(1), path)


def test_report_job(spark, tmp_path):
    source, out = Files(str(tmp_path / "in")), Files(str(tmp_path / "out"))

    def run():
        queries = start_reports(
            spark, source, out,
            Documents(path=str(tmp_path / "records")),
            Documents(path=str(tmp_path / "rejected")),
            str(tmp_path / "checkpoint"), once=True,
        )
        finish(*queries)

    publish_values(spark, source.path, ["COLLISION", "Crash Urgent", "COLLISION"])
    run()
    publish_values(spark, source.path, ["Traffic Hazard", "Elsewhere"],
                   lambda v: "TrafficHazard")
    run()
    records = spark.read.json(str(tmp_path / "records"))
    assert {r.issue: r.n for r in count_by(records, "issue").collect()} == {
        "COLLISION": 2, "Crash Urgent": 1, "Traffic Hazard": 1,
    }
    rejected = spark.read.json(str(tmp_path / "rejected")).collect()
    assert [(r.issue, r.reason) for r in rejected] == [("Elsewhere", "unknown category")]
    republished = topic_batches(spark, out.path, REPUBLISH_TOPIC)
    assert decode(republished, REPORT).count() == 4
    history = snapshots_of(spark, out.path, TOTALS_TOPIC)
    zeros = dict.fromkeys(ISSUES, 0)
    assert history == [
        (0, {**zeros, "COLLISION": 2, "Crash Urgent": 1}),
        (1, {**zeros, "COLLISION": 2, "Crash Urgent": 1, "Traffic Hazard": 1}),
    ]


def test_window_job(spark, tmp_path):
    source, out = Files(str(tmp_path / "in")), Files(str(tmp_path / "out"))
    table = to_folder(str(tmp_path / "table"))
    for values in (["COLLISION"], ["COLLISION", "Crash Service"]):
        publish_values(spark, source.path, values, lambda v: v.replace(" ", "") + "_batch")
        finish(start_windows(spark, source, out, str(tmp_path / "checkpoint"), table, once=True))
    history = [counts for _, counts in snapshots_of(spark, out.path, WINDOW_TOTALS_TOPIC)]
    zeros = dict.fromkeys(ISSUES, 0)
    assert history == [{**zeros, "COLLISION": 1}, {**zeros, "COLLISION": 2, "Crash Service": 1}]
    schema = "window_start timestamp, window_end timestamp, issue string, n bigint"
    newest = {}
    for r in read_batches(spark, str(tmp_path / "table"), schema).orderBy("batch_id").collect():
        newest[r.window_start, r.issue] = r.n
        assert (r.window_end - r.window_start).total_seconds() == 10.0
    assert sum(newest.values()) == 3


def test_window_table_job_runs_with_bounded_state(spark, tmp_path):
    source = Files(str(tmp_path / "in"))
    publish_values(spark, source.path, ["COLLISION"] * 3, lambda v: v + "_batch")
    query = start_window_table(
        spark, source, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True
    )
    finish(query)
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) == 3


def test_post_job(spark, tmp_path):
    source = Files(str(tmp_path / "in"))
    for codes in (["0", "0", "1"], ["1", "7", None]):
        rows = [(json.dumps({"id": "1", "sentiment": c}).encode(), POST_TOPIC) for c in codes]
        publish(spark.createDataFrame(rows, "value binary, topic string").coalesce(1), source.path)
        finish(
            *start_posts(
                spark, source, Documents(path=str(tmp_path / "documents")),
                to_folder(str(tmp_path / "totals")), str(tmp_path / "checkpoint"), once=True,
            )
        )
    documents = spark.read.json(str(tmp_path / "documents")).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["0"], r["1"], r["other"]) for r in documents] == [(0, 2, 1, 0), (1, 0, 1, 2)]
    assert snapshots_of(spark, str(tmp_path / "totals")) == [
        (0, {"positive": 2, "negative": 1}),
        (1, {"positive": 2, "negative": 4}),
    ]


def test_command_line_from_file_to_totals(spark, tmp_path):
    from tally.__main__ import parser, run

    lines = ["Traffic Report ID,Published Date,Issue Reported,Address"]
    lines += [f'{i},d,{issue},"a, b"' for i, issue in enumerate([*ISSUES, "COLLISION", "Other"])]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    place = lambda name: str(tmp_path / name)
    for argv in (
        ["publish-reports", place("in.csv"), place("topics")],
        ["reports", place("topics"), place("out"), place("documents"), "--checkpoint", place("c1"), "--once"],
        ["windows", place("topics"), place("out"), "--table", place("t"), "--checkpoint", place("c2"), "--once"],
        ["window-table", place("topics"), place("closed"), "--checkpoint", place("c3"), "--once"],
    ):
        run(spark, parser().parse_args(argv))
    expected = {**dict.fromkeys(ISSUES, 1), "COLLISION": 2}
    for topic in (TOTALS_TOPIC, WINDOW_TOTALS_TOPIC):
        assert snapshots_of(spark, place("out"), topic) == [(0, expected)]
    assert spark.read.json(f"{place('documents')}/records").count() == 5


def test_progress_is_logged(spark, folders, caplog):
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level("INFO", logger="tally"):
            run_batches(spark, folders, totals_query(folders), ["AAB"])
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert any("3 rows" in m for m in caplog.messages)


def test_wide_and_grouped_totals_agree(spark):
    df = spark.createDataFrame([(v,) for v in "AABBX"], "issue string")
    wide = label_counts(count_by(df, "issue"), LABELS, "issue").first()
    assert (wide.A, wide.B) == (2, 2)
    assert {r.issue: r.total for r in add_up(count_by(df, "issue"), "issue").collect()} == {
        "A": 2, "B": 2, "X": 1,
    }


def test_post_schema_is_text_only():
    assert all(f.endswith("string") for s in (POST, REPORT) for f in s.split(", "))
    assert topics_of(["a b"], "_batch") == ["ab_batch"]


def test_waiting_notices_any_query_that_fails(spark, folders):
    from tally.streaming import wait_for_any

    def fail(df, batch_id):
        raise RuntimeError("no such table")

    add_batch(spark, folders["log"], "A")
    spark.streams.resetTerminated()
    query = start(read(spark, folders["log"]), folders["checkpoint"], fail, once=True)
    try:
        with pytest.raises(Exception, match="no such table"):
            wait_for_any(spark)
    finally:
        spark.streams.resetTerminated()
    assert query.exception() is not None


def test_console_sink(spark, folders):
    add_batch(spark, folders["log"], "AB")
    query = start(read(spark, folders["log"]), folders["checkpoint"], fmt="console", once=True)
    finish(query)
    assert "console" in query.recentProgress[0].sink.description.lower()
    assert query.recentProgress[0].numInputRows == 2
