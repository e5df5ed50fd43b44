"""What the optimizer makes of the plans: scans, shuffles and where Python runs."""

import re

import pytest

import __spark_entry__ as driver
from tally.functions import decode, encode
from tally.operators import count_by, tracked
from tally.plans import batch_queries, inputs
from tally.schemas import POST, REPORT, REPORT_ISSUE
from tally.sinks import publish

SF = "/root/testdata/sf0.01"
BATCH = [n for n in batch_queries.QUERIES if n not in ("csv_scan", "csv_scan_multiline", "csv_scan_as_needed", "multi_source_union")]


def plan_of(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)", plan)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert node not in plan


@pytest.mark.parametrize(
    "name", ["decode_records", "encode_records", "filter_tracked", "topic_route",
             "topic_route_batch_only", "last_token", "quarantine_records"]
)
def test_record_steps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(driver.queries()[name](spark, SF))


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(driver.queries()["filter_tracked"](spark, SF))
    assert "PushedFilters: [In(event_type" in plan
    assert read_schemas(plan) == ["event_id:bigint,ts:timestamp_ntz,event_type:string"]


def test_counting_reads_only_what_it_counts(spark):
    assert read_schemas(plan_of(driver.queries()["zero_filled_counts"](spark, SF))) == ["event_type:string"]
    windows = plan_of(driver.queries()["window_counts_10s"](spark, SF))
    assert read_schemas(windows) == ["ts:timestamp_ntz,event_type:string"]
    assert all("text" not in s for s in read_schemas(plan_of(driver.queries()["sentiment_counts"](spark, SF))))


def test_texts_are_cut_to_tokens_before_the_join(spark):
    plan = plan_of(inputs.posts(spark, SF))
    assert plan.index("Join") < plan.index("substring_index")


@pytest.mark.parametrize("name", ["running_totals", "snapshot_prefix_sum", "snapshot_accumulate"])
def test_histories_read_the_events_once(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF), run=True)
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


def test_counts_are_combined_before_the_shuffle(spark):
    plan = plan_of(driver.queries()["batch_counts"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange") < plan.index("partial_count")


def test_unfiltered_decoding_parses_read_fields_only(spark):
    log = encode(inputs.reports(spark, SF), ["id", "datetime", "issue"])
    plan = plan_of(count_by(decode(log, REPORT), "issue"))
    assert "from_json(StructField(issue,StringType,true)," in plan


def test_a_filter_does_not_parse_again(spark):
    log = encode(inputs.reports(spark, SF), ["id", "datetime", "issue"])
    twice = plan_of(count_by(tracked(decode(log, REPORT), inputs.TRACKED), "issue"))
    once = plan_of(count_by(tracked(decode(log, REPORT_ISSUE, filtered=True), inputs.TRACKED), "issue"))
    parses = [len(re.findall(r"^.*(?:Project|Filter|Generate) .*from_json", p, re.M)) for p in (twice, once)]
    assert parses == [2, 1]


def test_a_hot_topic_is_cut_into_several_files(spark, tmp_path):
    """One topic holds three fifths of the rows, which come from eight files."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    log = inputs.report_log(spark, SF)
    hot = log.selectExpr("value", "if(topic in ('click', 'view'), topic, 'hot') AS topic")
    hot.repartition(8).write.parquet(str(tmp_path / "in"))
    spark.conf.set(name, "20kb")
    try:
        rows = spark.read.parquet(str(tmp_path / "in"))
        publish(rows, str(tmp_path / "out"), even_files=True)
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "out").glob("run=*/batch_id=*/topic=hot/*.parquet"))) >= 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10_000


def test_decoded_posts_keep_all_fields(spark):
    log = encode(inputs.posts(spark, SF), ["id", "sentiment", "hashtag"])
    assert decode(log, POST).columns == ["id", "sentiment", "hashtag"]
