"""Keyed messages to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.clicks import encode_clicks
from tallyworks.streaming.runtime import CLICK_INTERVAL, with_trigger


def write_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def write_clicks(clicks: DataFrame, brokers: str, topic: str) -> None:
    """Clicks as messages keyed by user."""
    encode_clicks(clicks).write.format("kafka").options(**write_options(brokers, topic)).save()


def start_click_messages(
    clicks: DataFrame,
    brokers: str,
    topic: str,
    checkpoint: str,
    every: str | None = CLICK_INTERVAL,
) -> StreamingQuery:
    """A stream of clicks as messages keyed by user."""
    writer = encode_clicks(clicks).writeStream.format("kafka")
    writer = writer.options(**write_options(brokers, topic))
    return with_trigger(writer, every).option("checkpointLocation", checkpoint).start()
