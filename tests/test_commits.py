"""What counts as written: logs of topic stores, runs of queries, start positions."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tally.commits import BatchId, claim_run, read_log, run_number, run_of
from tally.functions import decode
from tally.plans.endpoints import Documents, Files
from tally.plans.reports import start_reports
from tally.schemas import REPORT, TOTALS_TOPIC
from tally.sinks import publish, publish_stream, topic_writer, write_batch
from tally.sources import latest_batch, read_batches, topic_batches, topic_stream, topic_table
from tally.streaming import finish, latest_totals, running_totals, snapshot_sink, start, to_folder

MESSAGE = "value string, topic string"


def messages(spark, values, topic="A"):
    return spark.createDataFrame([(v, topic) for v in values], MESSAGE).coalesce(1)


def texts(rows):
    return sorted(bytes(r.value).decode() if not isinstance(r.value, str) else r.value for r in rows.collect())


def streamed(spark, path, tmp_path, topics=("A",)):
    """What a stream reads that starts at the same checkpoint every time."""
    log = topic_stream(spark, path, list(topics))
    finish(start(log, str(tmp_path / "reader"), path=str(tmp_path / "read"), once=True))
    return texts(spark.read.schema("value binary").parquet(str(tmp_path / "read")))


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "topics")


def stray(spark, folder):
    messages(spark, ["stray"]).select(F.col("value").cast("binary").alias("value")).write.mode("append").parquet(folder)


def test_files_that_the_log_does_not_list_do_not_count(spark, store, tmp_path):
    publish(messages(spark, ["one"]), store)
    stray(spark, f"{store}/run=1/batch_id=0/topic=A")
    stray(spark, f"{store}/run=7/batch_id=0/topic=A")
    assert texts(topic_table(spark, store, ["A"])) == ["one"]
    assert streamed(spark, store, tmp_path) == ["one"]


def test_a_stream_may_start_before_its_topics_exist(spark, store, tmp_path):
    assert streamed(spark, store, tmp_path) == []
    publish(messages(spark, ["other"], "B"), store)
    assert streamed(spark, store, tmp_path) == []
    publish(messages(spark, ["one"]), store)
    publish(messages(spark, ["two"]), store)
    assert streamed(spark, store, tmp_path) == ["one", "two"]
    assert texts(topic_table(spark, store, ["A"])) == ["one", "two"]


def test_tables_and_streams_write_to_one_store(spark, store, tmp_path):
    source = str(tmp_path / "source")
    publish(messages(spark, ["table"]), store)
    for values in (["s1"], ["s2", "s3"]):
        publish(messages(spark, values), source)
        log = topic_stream(spark, source, ["A"])
        writer = publish_stream(log, store, str(tmp_path / "writer"))
        finish(writer.trigger(availableNow=True).start())
    publish(messages(spark, ["table2"]), store, even_files=True)
    assert streamed(spark, store, tmp_path) == ["s1", "s2", "s3", "table", "table2"]
    runs = read_log(spark, store).select("run", "batch_id").distinct().collect()
    assert sorted(map(tuple, runs)) == [(1, 0), (2, 0), (2, 1), (3, 0)]


def test_an_attempt_that_ended_before_its_entry_is_replaced(spark, store, tmp_path, monkeypatch):
    from tally.sinks import topics

    send, batch = topic_writer(store, "A"), messages(spark, ["one"]).select("value")
    with monkeypatch.context() as m:
        m.setattr(topics, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            send(batch, BatchId(0, "r"))
    assert streamed(spark, store, tmp_path) == []
    again = topic_writer(store, "A")
    for _ in range(2):
        again(batch, BatchId(0, "r"))
    topic_writer(store, "A")(batch, BatchId(0, "r"))
    assert streamed(spark, store, tmp_path) == ["one"]


def test_a_run_may_write_several_topics_one_by_one(spark, store):
    for _ in range(2):
        for topic in "AB":
            topic_writer(store, topic)(messages(spark, [f"to {topic}"]).select("value"), BatchId(0, "r"))
    assert texts(topic_table(spark, store, ["A", "B"])) == ["to A", "to B"]
    assert [tuple(r) for r in topic_batches(spark, store, "B").collect()] == [("to B", 1, 0)]


def test_more_batches_than_the_log_keeps_apart(spark, store, tmp_path):
    send = topic_writer(store)
    for k in range(23):
        send(messages(spark, [f"{k:02d}"], "AB"[k % 2]), BatchId(k, "r"))
    send(messages(spark, []), BatchId(23, "r"))
    assert texts(topic_table(spark, store, ["A"])) == [f"{k:02d}" for k in range(0, 23, 2)]
    assert streamed(spark, store, tmp_path, "AB") == [f"{k:02d}" for k in range(23)]


def test_writers_at_the_same_time_lose_nothing(spark, store):
    batches = {w: [messages(spark, [f"{w}-{k}"]) for k in range(8)] for w in range(4)}

    def send(writer):
        write = topic_writer(store)
        for k, batch in enumerate(batches[writer]):
            write(batch, BatchId(k, f"run-{writer}"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(send, batches))
    assert texts(topic_table(spark, store, ["A"])) == sorted(f"{w}-{k}" for w in range(4) for k in range(8))


def test_folders_without_a_log_are_read_but_not_written(spark, store):
    stray(spark, f"{store}/topic=A")
    assert texts(topic_table(spark, store, ["A"])) == ["stray"]
    with pytest.raises(ValueError, match="without a log"):
        publish(messages(spark, ["one"]), store)


def test_only_the_named_topics_folders_are_read(spark, store):
    publish(messages(spark, ["one"]).unionByName(messages(spark, ["two"], "B")), store)
    table = topic_table(spark, store, ["A"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [topic" in plan or "PartitionFilters: [isnotnull(topic" in plan
    assert "MetadataLogFileIndex" in plan


def test_runs_are_numbered_in_the_order_of_their_first_batch(spark, tmp_path):
    place = str(tmp_path / "out")
    first, second = (run_of(spark, str(tmp_path / c)) for c in ("c1", "c2"))
    assert first != second and run_of(spark, str(tmp_path / "c1")) == first
    assert [run_number(spark, place, r) for r in (second, first, second, None)] == [1, 2, 1, 0]
    assert claim_run(spark, place, "x") == 3
    assert run_number(spark, str(tmp_path / "other"), first) == 1
    assert BatchId(3, "r") == 3 and BatchId(3, "r").key == "r/3" and BatchId(3).key == "3"


def totals(spark, log, out, checkpoint):
    records = decode(spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).json(log), REPORT)
    finish(
        start(
            running_totals(records, ["A"]), checkpoint, snapshot_sink(to_folder(out), ["A"]),
            mode="complete", once=True, state_width=1,
        )
    )


def test_a_new_checkpoint_on_an_old_output_is_newer(spark, tmp_path):
    """Three batches of one record each; then, from a new checkpoint, batches of four and three."""
    out = str(tmp_path / "out")
    for run, sizes in (("c1", (1, 1, 1)), ("c2", (4, 3))):
        for n in sizes:
            rows = [('{"id":"1","issue":"A"}',)] * n
            spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").json(str(tmp_path / f"log-{run}"))
            totals(spark, str(tmp_path / f"log-{run}"), out, str(tmp_path / run))
    history = read_batches(spark, out, "value string")
    assert sorted((r.run, r.batch_id) for r in history.collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]
    assert [tuple(r) for r in latest_totals(history).collect()] == [("A", 7)]
    assert [r.value for r in latest_batch(history).collect()] == ['{"A":7}']


def test_plain_batch_numbers_are_one_run(spark, tmp_path):
    for n in (2, 3):
        write_batch(spark.range(n), str(tmp_path), 4)
    assert read_batches(spark, str(tmp_path), "id bigint").count() == 3


def report(i, issue="A"):
    return f'{{"id":"{i}","datetime":"d","issue":"{issue}"}}'


def job(spark, tmp_path, source, name):
    finish(
        *start_reports(
            spark, source, Files(str(tmp_path / f"out-{name}")),
            Documents(path=str(tmp_path / f"records-{name}")), Documents(path=str(tmp_path / f"rejected-{name}")),
            str(tmp_path / f"c-{name}"), ["A"], once=True,
        )
    )
    return latest_totals(topic_batches(spark, str(tmp_path / f"out-{name}"), TOTALS_TOPIC))


def test_a_job_starts_before_its_topics_and_reads_them_later(spark, store, tmp_path):
    assert job(spark, tmp_path, Files(store), "all").collect() == []
    publish(messages(spark, [report(1), report(2)]), store)
    assert [tuple(r) for r in job(spark, tmp_path, Files(store), "all").collect()] == [("A", 2)]


def test_a_start_at_the_latest_position_reads_what_comes_later(spark, store, tmp_path):
    publish(messages(spark, [report(1), report(2)]), store)
    publish(messages(spark, [report(3)]), store)
    running = topic_writer(store)
    running(messages(spark, [report(4)]), BatchId(0, "r"))
    late = Files(store, start="latest")
    assert [r.n for r in job(spark, tmp_path, late, "late").collect()] in ([], [0])
    running(messages(spark, [report(5)]), BatchId(1, "r"))
    publish(messages(spark, [report(6)]), store)
    assert [tuple(r) for r in job(spark, tmp_path, late, "late").collect()] == [("A", 2)]
    records = spark.read.json(str(tmp_path / "records-late"))
    assert sorted(r.id for r in records.collect()) == ["5", "6"]
    # The position counts for a new checkpoint only.
    assert [tuple(r) for r in job(spark, tmp_path, Files(store), "early").collect()] == [("A", 6)]
    publish(messages(spark, [report(7)]), store)
    assert [tuple(r) for r in job(spark, tmp_path, late, "early").collect()] == [("A", 7)]
    with pytest.raises(ValueError, match="checkpoint"):
        late.stream(spark, ["A"])
