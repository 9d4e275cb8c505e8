"""Starting queries: triggers, checkpoints and per-batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# The batch intervals of the click and word-frequency jobs.
CLICK_INTERVAL = "10 seconds"
WORD_INTERVAL = "3 seconds"


BatchHandler = Callable[[DataFrame, int], None]

STATE_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Let queries started inside keep their state in RocksDB rather than in memory.

    A query takes the setting over when it starts, and one with a checkpoint goes on
    with the store it began with. Other queries of the session keep their own.
    """
    before = spark.conf.get(STATE_STORE_SETTING, None)
    spark.conf.set(STATE_STORE_SETTING, ROCKSDB_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE_SETTING)
        else:
            spark.conf.set(STATE_STORE_SETTING, before)


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run every so often; without an interval, take all available input and stop."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def start_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = CLICK_INTERVAL,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, every).option("checkpointLocation", checkpoint).start(path)


def start_batches(
    stream: DataFrame,
    handle: BatchHandler,
    checkpoint: str,
    every: str | None = CLICK_INTERVAL,
    output_mode: str = "append",
    wrap: Callable[[BatchHandler], BatchHandler] | None = None,
) -> StreamingQuery:
    """Call ``handle`` with each non-empty batch and its number.

    Offsets are logged before a batch and committed after it, so a restart on
    the same checkpoint repeats at most the batch that was interrupted. ``wrap``
    puts something around the handler, such as a measurement or a fault.
    """
    handle = wrap(handle) if wrap else handle

    def run(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            handle(batch, number)

    writer = stream.writeStream.outputMode(output_mode).foreachBatch(run)
    return with_trigger(writer, every).option("checkpointLocation", checkpoint).start()


def start_console(
    stream: DataFrame, checkpoint: str, every: str | None = CLICK_INTERVAL, rows: int = 10
) -> StreamingQuery:
    """Print the first rows of each batch."""
    writer = stream.writeStream.format("console").option("numRows", rows)
    return with_trigger(writer, every).option("checkpointLocation", checkpoint).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a query that takes the available input and stops."""
    query.awaitTermination()
