"""Streaming click state: all-time and sliding item sets per user, and offsets."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.clicks import SLIDE, WINDOW, offset_ranges
from tallyworks.operators.grouping import PIECE_WIDTH, collect_by_range, range_piece
from tallyworks.operators.panes import item_panes, window_runs
from tallyworks.streaming.runtime import (
    CLICK_INTERVAL,
    BatchHandler,
    start_batches,
    start_table,
    state_on_disk,
)

DAY_PARTITION = "yyyyMMdd"


def new_user_items(clicks: DataFrame) -> DataFrame:
    """Each user-item pair the first time it is seen, with no expiry.

    The state is one row per pair, spread by the pair, so a user with a large
    share of all clicks is not a large partition.
    """
    return clicks.select("user_id", "item").dropDuplicates(["user_id", "item"])


def start_user_items(
    clicks: DataFrame, path: str, checkpoint: str, every: str | None = CLICK_INTERVAL
) -> StreamingQuery:
    """Keep a table of all user-item pairs; read the sets with ``read_user_item_sets``."""
    with state_on_disk(clicks.sparkSession):
        return start_table(new_user_items(clicks), path, checkpoint, every)


def read_user_item_sets(spark: SparkSession, path: str, width: int = PIECE_WIDTH) -> DataFrame:
    """The sets as of now: ``user_id, piece, items``. The pairs are already distinct."""
    return collect_by_range(spark.read.parquet(path), ["user_id"], "item", "items", width=width)


def all_user_item_sets(clicks: DataFrame, width: int = PIECE_WIDTH) -> DataFrame:
    """The sets as one streaming aggregate, for output mode ``complete`` or ``update``.

    Each state row holds the items of one range of ``width`` item numbers, so its size is bounded.
    """
    return clicks.groupBy("user_id", range_piece(F.col("item"), width).alias("piece")).agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


# --- pairs that expire


def item_visits(clicks: DataFrame, keep: str, delay: str) -> DataFrame:
    """Pairs with a time to live: ``user_id, item, first_seen, last_seen, expires, n``, for output mode ``append``.

    A pair lives until no click of it has come for ``keep``; a click after that
    begins a new visit. The state holds one row per living pair and drops it when the
    watermark, ``delay`` behind the newest click, has passed its end.
    """
    visit = F.session_window("ts", keep)
    return (
        clicks.withWatermark("ts", delay)
        .groupBy("user_id", "item", visit.alias("visit"))
        .agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n"))
        .select("user_id", "item", "first_seen", "last_seen", F.col("visit.end").alias("expires"), "n")
    )


def start_item_visits(
    clicks: DataFrame, path: str, checkpoint: str, keep: str, delay: str, every: str | None = CLICK_INTERVAL
) -> StreamingQuery:
    """Append the visits that have ended to a table."""
    with state_on_disk(clicks.sparkSession):
        return start_table(item_visits(clicks, keep, delay), path, checkpoint, every)


def living_items(visits: DataFrame, at: datetime, width: int = PIECE_WIDTH) -> DataFrame:
    """The sets as of ``at``: ``user_id, piece, items`` of the pairs seen by then and not expired."""
    then = F.lit(at).cast("timestamp")
    alive = visits.where((F.col("first_seen") <= then) & (F.col("expires") > then))
    return collect_by_range(alive, ["user_id"], "item", "items", width=width, distinct=True)


# --- sliding windows


def start_item_panes(
    clicks: DataFrame,
    path: str,
    checkpoint: str,
    delay: str,
    slide: str = SLIDE,
    width: int = PIECE_WIDTH,
    every: str | None = CLICK_INTERVAL,
) -> StreamingQuery:
    """Append each user's closed panes to a table; read windows with ``read_item_runs``.

    A click is in the state once, in the row of its user, pane and piece, and
    leaves it when the watermark, ``delay`` behind the newest click, has passed the pane.
    """
    panes = item_panes(clicks.withWatermark("ts", delay), slide, width)
    with state_on_disk(clicks.sparkSession):
        return start_table(panes, path, checkpoint, every)


def read_item_runs(spark: SparkSession, path: str, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """The windows as of the panes that are closed by now, as runs (see ``window_runs``)."""
    return window_runs(spark.read.parquet(path), window, slide)


def _day_of(ts: Column) -> Column:
    """The day in UTC, whatever zone the session has, so that writers and readers agree."""
    days = F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int")
    return F.date_format(F.date_from_unix_date(days), DAY_PARTITION)


def start_click_table(
    clicks: DataFrame, path: str, checkpoint: str, every: str | None = CLICK_INTERVAL
) -> StreamingQuery:
    """Append clicks to a table by day, without any state.

    A window read from it touches only the days it covers; repeats fall away
    when the sets are built, so late and repeated clicks need no special care.
    """
    dated = clicks.select("ts", "user_id", "item", _day_of(F.col("ts")).alias("day"))
    return start_table(dated, path, checkpoint, every, ["day"])


def read_click_table(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Clicks from ``start`` until before ``end``; other days are not read."""
    clicks = spark.read.schema("ts TIMESTAMP, user_id STRING, item INT, day STRING").parquet(path)
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        at = F.lit(bound).cast("timestamp")
        day = _day_of(at)
        if is_start:
            clicks = clicks.where((F.col("day") >= day) & (F.col("ts") >= at))
        else:
            clicks = clicks.where((F.col("day") <= day) & (F.col("ts") < at))
    return clicks.drop("day")


def start_offset_report(
    records: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = CLICK_INTERVAL,
    wrap: Callable[[BatchHandler], BatchHandler] | None = None,
) -> StreamingQuery:
    """Write the offset range of each topic partition for every batch, once per batch."""

    def report(batch: DataFrame, number: int) -> None:
        offset_ranges(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return start_batches(records, report, checkpoint, every, wrap=wrap)


def read_offset_report(spark: SparkSession, path: str) -> DataFrame:
    """Offset ranges per batch."""
    return spark.read.option("basePath", path).parquet(path)


def offset_ledger(report: DataFrame) -> DataFrame:
    """The report with ``follows``: whether a batch begins where the one before it ended, and has no hole inside.

    A row per batch and topic partition; the first batch of a partition follows if it is whole.
    """
    earlier = Window.partitionBy("topic", "partition").orderBy("batch")
    whole = F.col("n") == F.col("until_offset") - F.col("from_offset")
    joins = F.coalesce(F.lag("until_offset").over(earlier) == F.col("from_offset"), F.lit(True))
    return report.withColumn("follows", whole & joins)
