"""Column expressions: text, payload coding, maps."""

from tally.functions.codec import (
    decode,
    decode_checked,
    decode_snapshots,
    encode,
    json_text,
    snapshot_json,
)
from tally.functions.columns import (
    block_of,
    count_of,
    last_token,
    polarity,
    quoted,
    topic_name,
    with_batch_topic,
    without_spaces,
)

__all__ = [
    "block_of",
    "count_of",
    "decode",
    "decode_checked",
    "decode_snapshots",
    "encode",
    "json_text",
    "last_token",
    "polarity",
    "quoted",
    "snapshot_json",
    "topic_name",
    "with_batch_topic",
    "without_spaces",
]
