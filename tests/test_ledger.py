"""Totals that commit with the records, windows in bounded state, and what is reported."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tally.commits import BatchId
from tally.functions import decode, decode_checked, encode
from tally.operators import count_by
from tally.plans.endpoints import Documents, Files
from tally.plans.reports import LEDGER, record_outputs
from tally.plans.shares import once_each
from tally.plans.windows import start_untimed, start_window_table, start_windows
from tally.schemas import REPORT, WINDOW_TOTALS_TOPIC
from tally.sinks import publish, write_batch
from tally.sources import file_stream, read_batches, topic_batches
from tally.streaming import (
    ProgressLog,
    count_ledger,
    fan_out,
    finish,
    ledger_history,
    ledger_sink,
    ledger_totals,
    observed,
    running_totals,
    snapshot_sink,
    start,
    state_rows,
    state_totals,
    to_folder,
    window_ledger,
)

LABELS = ["A", "B"]
TABLE = "window_start timestamp, window_end timestamp, issue string, n bigint"


def add_batch(spark, folder, values):
    rows = [(str(i), "2024-01-01 00:00:00", v) for i, v in enumerate(values)]
    records = spark.createDataFrame(rows, REPORT).coalesce(1)
    encode(records, ["id", "datetime", "issue"]).write.mode("append").parquet(folder)


def counts(spark, text):
    return count_by(spark.createDataFrame([(c,) for c in text] or [("X",)], "issue string"), "issue")


def totals_of(rows):
    return {r.issue: r.n for r in rows.collect()}


def test_entries_add_up_and_repeats_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    record = count_ledger(path, LABELS)
    for number, text in [(0, "AAB"), (1, "B"), (1, "B"), (2, "X"), (5, "AX"), (0, "AAB")]:
        record(counts(spark, text), BatchId(number, "r"))
    assert totals_of(ledger_totals(spark, path)) == {"A": 3, "B": 2}
    history = ledger_history(spark, path, LABELS).orderBy("batch_id")
    assert [tuple(r) for r in history.collect()] == [(0, 2, 1), (1, 2, 2), (2, 2, 2), (5, 3, 2)]


def test_a_run_far_behind_its_last_entry_still_finds_it(spark, tmp_path):
    record = count_ledger(str(tmp_path), LABELS)
    record(counts(spark, "A"), BatchId(3, "r"))
    record(counts(spark, "A"), BatchId(40, "r"))
    record(counts(spark, "AB"), BatchId(0, "other"))
    assert totals_of(ledger_totals(spark, str(tmp_path))) == {"A": 1, "B": 1}
    rows = read_batches(spark, str(tmp_path), "issue string, n bigint, total bigint").filter("run = 1")
    assert {r.batch_id: r.total for r in rows.filter("issue = 'A'").collect()} == {3: 1, 40: 2}


@pytest.mark.parametrize("broken_output", ["records", "republished", "totals", "published"])
def test_totals_equal_records_after_a_failure_between_outputs(spark, tmp_path, broken_output):
    """Each run is killed once before one of its outputs; then it goes on."""
    place = lambda name: str(tmp_path / name)
    broken = {}

    def sink(name, write):
        def guarded(df, batch_id):
            if name == broken_output and broken.pop("yes", False):
                raise RuntimeError("killed")
            write(df, batch_id)

        return guarded

    def run():
        record = count_ledger(place(LEDGER), LABELS)
        publish_totals = sink("published", to_folder(place("snapshots")))
        outputs = record_outputs(
            sink("records", to_folder(place("records"))),
            sink("republished", to_folder(place("republished"))),
            to_folder(place("rejected")),
            labels=LABELS,
            totals=sink("totals", ledger_sink(record, publish_totals, LABELS)),
        )
        log = file_stream(spark, place("log"), "value binary")
        return start(decode_checked(log, REPORT), place("checkpoint"), fan_out(outputs), once=True)

    for values in ("ABA", "XBBB", "A"):
        add_batch(spark, place("log"), values)
        broken["yes"] = True
        with pytest.raises(Exception, match="killed"):
            finish(run())
        finish(run())
    records = totals_of(count_by(read_batches(spark, place("records"), REPORT), "issue"))
    assert records == totals_of(ledger_totals(spark, place(LEDGER))) == {"A": 3, "B": 4}
    snapshots = read_batches(spark, place("snapshots"), "value string").orderBy("batch_id").collect()
    assert [json.loads(r.value) for r in snapshots] == [{"A": 2, "B": 1}, {"A": 2, "B": 4}, {"A": 3, "B": 4}]


def window(spark, rows):
    """Rows of (seconds, label, count) as changed windows."""
    data = [(int(s), int(s) + 10, label, n) for s, label, n in rows]
    frame = spark.createDataFrame(data, "a bigint, b bigint, issue string, n bigint")
    times = [F.timestamp_seconds(c).alias(name) for c, name in (("a", "window_start"), ("b", "window_end"))]
    return frame.select(*times, "issue", "n")


def test_changed_windows_count_once_and_old_ones_are_forgotten(spark, tmp_path):
    rnd, record = random.Random(4), window_ledger(str(tmp_path), ["10 seconds", "30 seconds"], LABELS)
    now, true = 1000, {}
    for batch in range(8):
        changed = {}
        for _ in range(4):
            key = (now - 10 * rnd.randint(0, 3), rnd.choice(LABELS))
            true[key] = changed[key] = true.get(key, 0) + rnd.randint(1, 5)
        batch_rows = window(spark, [(s, label, n) for (s, label), n in changed.items()] + [(now, "X", 9)])
        for _ in range(2):
            record(batch_rows, BatchId(batch, "r"))
        now += 10 * rnd.randint(0, 2)
    want = {label: sum(n for (_, x), n in true.items() if x == label) for label in LABELS}
    assert totals_of(ledger_totals(spark, f"{tmp_path}/totals")) == want
    kept = read_batches(spark, f"{tmp_path}/open", TABLE)
    assert kept.filter("batch_id = 7").count() < len(true)


def put(spark, source, times, label="A"):
    rows = [(str(i), t, label) for i, t in enumerate(times)]
    log = encode(spark.createDataFrame(rows, REPORT), ["id", "datetime", "issue"]).withColumn("topic", F.lit(f"{label}_batch"))
    publish(log, source.path)


def test_a_trigger_writes_only_windows_that_it_changes(spark, tmp_path):
    """Ten restarts, a minute of record time apart: each writes its own windows, and neither
    the state nor the ledger's open windows grow."""
    source, out, place = Files(str(tmp_path / "in")), Files(str(tmp_path / "out")), str(tmp_path / "table")
    sizes = []
    for minute in range(10):
        put(spark, source, [f"2024-01-01 00:{minute:02d}:{s:02d}" for s in (1, 2, 15)])
        query = start_windows(
            spark, source, out, str(tmp_path / "c"), to_folder(place), LABELS, once=True, event_time=True
        )
        finish(query)
        sizes.append(query.recentProgress[-1].stateOperators[0].numRowsTotal)
    table = read_batches(spark, place, TABLE)
    per_batch = table.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("window_start").alias("first"))
    assert [r.n for r in per_batch.collect()] == [2] * 10
    assert table.select("window_start").distinct().count() == 20
    assert max(sizes) <= 4
    opened = read_batches(spark, str(tmp_path / "c" / "window-ledger" / "open"), TABLE)
    assert max(r["count"] for r in opened.groupBy("batch_id").count().collect()) <= 4
    history = topic_batches(spark, out.path, WINDOW_TOTALS_TOPIC).orderBy("batch_id").collect()
    assert [json.loads(r.value) for r in history] == [{"A": 3 * (k + 1), "B": 0} for k in range(10)]


def test_a_window_that_goes_on_in_the_next_batch_counts_its_gain(spark, tmp_path):
    source, out = Files(str(tmp_path / "in")), Files(str(tmp_path / "out"))
    for seconds in ([1, 2], [3, 11], [4, 12, 13]):
        put(spark, source, [f"2024-01-01 00:00:{s:02d}" for s in seconds])
        finish(start_windows(spark, source, out, str(tmp_path / "c"), None, LABELS, once=True, event_time=True))
    history = topic_batches(spark, out.path, WINDOW_TOTALS_TOPIC).orderBy("batch_id").collect()
    assert [json.loads(r.value)["A"] for r in history] == [2, 4, 7]


def test_closed_windows_and_reports_without_a_time(spark, tmp_path):
    source, rejected = Files(str(tmp_path / "in")), str(tmp_path / "rejected")
    put(spark, source, ["2024-01-01 00:00:01", None, "soon", "2024-01-01 00:00:02", "2024-01-01 00:01:00", ""])
    put(spark, source, [None], "Other")
    finish(
        start_window_table(
            spark, source, str(tmp_path / "table"), str(tmp_path / "c"), LABELS, once=True, event_time=True
        ),
        start_untimed(spark, source, Documents(path=rejected), str(tmp_path / "c"), LABELS, once=True),
    )
    closed = spark.read.schema(TABLE).parquet(str(tmp_path / "table")).collect()
    assert [(str(r.window_start), r.n) for r in closed] == [("2024-01-01 00:00:00", 2)]
    aside = spark.read.json(rejected).collect()
    assert sorted((r.reason, r.issue) for r in aside) == [
        ("no time", "A"), ("unreadable time", "A"), ("unreadable time", "A"),
    ]


def test_totals_and_late_rows_are_reported(spark, tmp_path, caplog):
    listener, source = ProgressLog(), Files(str(tmp_path / "in"))
    spark.streams.addListener(listener)
    try:
        with caplog.at_level("INFO", logger="tally"):
            add_batch(spark, str(tmp_path / "log"), "AABX")
            records = decode(file_stream(spark, str(tmp_path / "log"), "value binary"), REPORT)
            sink = snapshot_sink(to_folder(str(tmp_path / "out")), LABELS)
            query = start(
                observed(running_totals(records, LABELS), LABELS), str(tmp_path / "c"), sink,
                mode="complete", once=True, state_width=2, name="sums",
            )
            finish(query)
            for times in (["2024-01-01 00:00:01"], ["2024-01-01 01:00:00"], ["2024-01-01 00:00:02"]):
                put(spark, source, times)
                finish(
                    start_windows(
                        spark, source, Files(str(tmp_path / "o")), str(tmp_path / "w"), None, LABELS,
                        once=True, event_time=True,
                    )
                )
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert any("sums batch 0: totals" in m and str({"A": 2, "B": 1}) in m for m in caplog.messages)
    assert any("rows too late" in m for m in caplog.messages)
    assert any(m.startswith("totals after batch") and str({"A": 2, "B": 0}) in m for m in caplog.messages)


def test_state_is_read_back_after_any_batch(spark, tmp_path):
    for values in ("AB", "AAX"):
        add_batch(spark, str(tmp_path / "log"), values)
        records = decode(file_stream(spark, str(tmp_path / "log"), "value binary"), REPORT)
        sink = snapshot_sink(to_folder(str(tmp_path / "out")), LABELS)
        finish(start(running_totals(records, LABELS), str(tmp_path / "c"), sink, mode="complete", once=True, state_width=2))
    assert totals_of(state_totals(spark, str(tmp_path / "c"))) == {"A": 3, "B": 1}
    assert totals_of(state_totals(spark, str(tmp_path / "c"), batch_id=0)) == {"A": 1, "B": 1}
    assert state_rows(spark, str(tmp_path / "c")).columns == ["issue", "count"]


def test_state_for_repeated_messages_stays_flat(spark, tmp_path):
    """Ten messages a batch, each sent twice, an hour apart; the state keeps two hours of them."""
    log, sizes = str(tmp_path / "log"), []
    schema = "run string, batch_id bigint, value string, written timestamp"
    for hour in range(10):
        rows = [("r", 10 * hour + k, "m") for k in range(10)] * 2
        frame = spark.createDataFrame(rows, "run string, batch_id bigint, value string")
        frame.withColumn("written", F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hour))).write.mode("append").parquet(log)
        query = start(
            once_each(file_stream(spark, log, schema), "90 minutes"), str(tmp_path / "c"),
            lambda df, b: write_batch(df, str(tmp_path / "out"), b), once=True, state_width=2,
        )
        finish(query)
        sizes.append(query.recentProgress[-1].stateOperators[0].numRowsTotal)
    assert read_batches(spark, str(tmp_path / "out"), schema.rsplit(",", 1)[0].replace("batch_id", "id")).count() == 100
    assert max(sizes[4:]) <= max(sizes[:4]) <= 40


def test_only_texts_that_can_hold_more_are_parsed_again(spark):
    payloads = {
        '{"id":"1","issue":"A"}': False, ' {"id":"1","issue":"A"}  ': False, '{"id":"1","issue":"A"} {"id":"2"}': True,
        '{"id":"1","issue":"A"}]': True, '{"id":"}","issue":"A"}': False, '{"id":"}","issue":"A"} x': True,
        '{"id":"1","issue":"A","more":{"x":"1"}}': False, '{"id":"1","issue":"A"}\n': False, '{"issue":"A"},{"issue":"B"}': True,
    }
    log = spark.createDataFrame([(p,) for p in payloads], "text string").select(F.col("text").cast("binary").alias("value"))
    assert {r.raw: r.rest for r in decode_checked(log, REPORT).collect()} == payloads
