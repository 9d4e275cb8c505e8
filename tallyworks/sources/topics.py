"""Message topics: reader options, and records in the shape the Kafka source has.

The options are plain dictionaries, so a job can be tested on any frame with the
columns of ``RECORD_SCHEMA``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = (
    "key STRING, value STRING, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP"
)

# The rate cap, in messages per second and partition.
DEFAULT_RATE = 5
DEFAULT_INTERVAL_SECONDS = 3


def starting_offsets(start: str | dict = "latest") -> str:
    """Where a query without a checkpoint begins.

    ``smallest`` and ``earliest`` mean the oldest record kept; a dictionary
    ``{topic: {partition: offset}}`` gives explicit offsets; all else means the
    newest. A query with a checkpoint always resumes from its own offsets.
    """
    if isinstance(start, dict):
        return json.dumps(
            {t: {str(p): int(o) for p, o in parts.items()} for t, parts in start.items()}
        )
    return "earliest" if start.lower() in ("smallest", "earliest") else "latest"


def rate_cap(
    partitions: int,
    per_partition: int = DEFAULT_RATE,
    interval_seconds: int = DEFAULT_INTERVAL_SECONDS,
) -> int:
    """The cap per second and partition as a total per trigger."""
    return partitions * per_partition * interval_seconds


def topic_options(
    brokers: str | list[str],
    topics: str | list[str],
    group: str | None = None,
    start: str | dict = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Options of the Kafka source.

    With ``fail_on_data_loss`` off, offsets that retention has removed are
    skipped and reading goes on at the oldest record kept, per partition.
    """

    def joined(names: str | list[str]) -> str:
        parts = names.split(",") if isinstance(names, str) else names
        return ",".join(p.strip() for p in parts)

    options = {
        "kafka.bootstrap.servers": joined(brokers),
        "subscribe": joined(topics),
        "startingOffsets": starting_offsets(start),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def text_records(records: DataFrame) -> DataFrame:
    """Binary keys and values as text, with the other record columns."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return text_records(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A topic as a batch, from its oldest record unless the options say otherwise."""
    settings = {**options, "startingOffsets": "earliest"}
    if options.get("startingOffsets", "latest") != "latest":
        settings["startingOffsets"] = options["startingOffsets"]
    for streaming_only in ("maxOffsetsPerTrigger",):
        settings.pop(streaming_only, None)
    return text_records(spark.read.format("kafka").options(**settings).load())


def record_tail(records: DataFrame) -> DataFrame:
    """``offset, key, value`` of raw records."""
    return records.select("offset", "key", "value")


def stream_record_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of topic-shaped records as a stream."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
