"""Replayed messages dropped on the stream itself, with state bounded by time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.transactions import POSITION
from ledgerlens.streaming.bronze import parse, start_append

# How long after its first delivery a message may be delivered again.
DELAY = "1 day"


def without_replays(parsed: DataFrame, delay: str = DELAY, stamp: str = "kafka_timestamp") -> DataFrame:
    """One row per stream position. A copy whose timestamp is at most `delay` from the first
    one's is dropped; the position leaves the state store once the watermark has passed it by
    that much, so the state follows the traffic of one delay and not the age of the stream."""
    return parsed.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(POSITION)


def start_deduped(messages: DataFrame, path: str, checkpoint: str, once: bool = True, delay: str = DELAY) -> StreamingQuery:
    """Bronze without replays: parsed messages, each position once."""
    return start_append(without_replays(parse(messages), delay), path, checkpoint, once)
