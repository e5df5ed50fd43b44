"""Record layouts and the category vocabulary."""

from __future__ import annotations

# Field names of the wire records. All fields are nullable text.
POST = "id string, sentiment string, hashtag string"
REPORT = "id string, datetime string, issue string"

# The parts of the records that counting needs.
POST_SENTIMENT = "sentiment string"
REPORT_ISSUE = "issue string"

# Columns of the delimited input files that become record fields.
POST_COLUMNS = {"id": "ItemID", "sentiment": "Sentiment", "text": "SentimentText"}
REPORT_COLUMNS = {
    "id": "Traffic Report ID",
    "datetime": "Published Date",
    "issue": "Issue Reported",
}

# The issue labels that are counted.
ISSUES = ("Traffic Hazard", "Crash Urgent", "Crash Service", "COLLISION")

# Topic names shared with existing publishers and readers.
POST_TOPIC = "sentiment"
REPUBLISH_TOPIC = "output"
TOTALS_TOPIC = "aggregate_count"
WINDOW_TOTALS_TOPIC = "aggregate_count_batch"
BATCH_SUFFIX = "_batch"

# Polarity of a sentiment code; every other code, or none, is negative.
POSITIVE_CODE = "0"
POLARITIES = ("positive", "negative")

SNAPSHOT = "map<string,bigint>"

# A topic log is a table of opaque payloads, laid out in folders by run and batch of the
# writer, and by topic.
LOG = "value binary, topic string, run bigint, batch_id bigint"
