"""Item sets per user, over all time and in sliding windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import STRICT, all_sound, char_pattern, check_mode
from tallyworks.operators.grouping import PIECE_WIDTH, collect_by_range
from tallyworks.operators.panes import item_panes, single_windows, window_runs

# The layout of a click record.
SEPARATOR = "\t"
TIME_FIELD = 0
USER_FIELD = 1
ITEM_FIELD = 2

# Length and step of the sliding window.
WINDOW = "3600 seconds"
SLIDE = "30 seconds"


def parse_clicks(
    records: DataFrame,
    *keep: str,
    value: str = "value",
    separator: str = SEPARATOR,
    mode: str = STRICT,
) -> DataFrame:
    """``ts, user_id, item`` of tab-separated clicks with epoch milliseconds.

    Strict mode fails on a record without a user or with a bad number; permissive
    mode leaves it out (see ``malformed_clicks``).
    """
    check_mode(mode)
    fields = _click_fields(value, separator)
    sound = _is_sound(fields)
    if mode == STRICT:
        sound = all_sound(sound, F.col(value), "click")
    parsed = records.where(sound).select(*keep, *[field.alias(n) for n, field in fields.items()])
    return parsed.select(
        *keep, F.timestamp_millis("ts_ms").alias("ts"), "user_id", "item"
    )


def malformed_clicks(
    records: DataFrame, value: str = "value", separator: str = SEPARATOR
) -> DataFrame:
    """The records that permissive parsing leaves out."""
    sound = _is_sound(_click_fields(value, separator))
    return records.where(~sound)


def _click_fields(value: str, separator: str) -> dict:
    pieces = F.split(F.col(value), char_pattern(separator))
    return {
        "ts_ms": F.get(pieces, F.lit(TIME_FIELD)).try_cast("long"),
        "user_id": F.get(pieces, F.lit(USER_FIELD)),
        "item": F.get(pieces, F.lit(ITEM_FIELD)).try_cast("int"),
    }


def _is_sound(fields: dict):
    return fields["ts_ms"].isNotNull() & fields["user_id"].isNotNull() & fields["item"].isNotNull()


def encode_clicks(
    clicks: DataFrame,
    *keep: str,
    ts: str = "ts",
    user: str = "user_id",
    item: str = "item",
    separator: str = SEPARATOR,
) -> DataFrame:
    """Clicks as keyed messages: ``key`` is the user, ``value`` the separated record."""
    return clicks.select(
        *keep,
        F.col(user).cast("string").alias("key"),
        F.concat_ws(
            separator,
            F.unix_millis(ts).cast("string"),
            F.col(user).cast("string"),
            F.col(item).cast("string"),
        ).alias("value"),
    )


def user_items(clicks: DataFrame) -> DataFrame:
    """The item sets in long form: one row per user and item, spread by the pair."""
    return clicks.select("user_id", "item").distinct()


def user_item_sets(clicks: DataFrame, width: int = PIECE_WIDTH) -> DataFrame:
    """All items of each user as sorted arrays: ``user_id, piece, items``, a piece for each ``width`` item numbers."""
    return collect_by_range(clicks, ["user_id"], "item", "items", width=width, distinct=True)


def user_item_runs(
    clicks: DataFrame, window: str = WINDOW, slide: str = SLIDE, width: int = PIECE_WIDTH
) -> DataFrame:
    """Every sliding window of each user, windows of equal content together: ``user_id, piece, first_start, last_start, clicks``.

    Put together from panes (see ``panes``), so a fine slide does not multiply the clicks.
    """
    return window_runs(item_panes(clicks, slide, width), window, slide)


def user_item_windows(
    clicks: DataFrame, window: str = WINDOW, slide: str = SLIDE, width: int = PIECE_WIDTH
) -> DataFrame:
    """Every sliding window of each user: ``user_id, window_start, piece, clicks``.

    The result holds each click ``window / slide`` times, as it asks for every
    window; ``user_item_runs`` says the same in fewer rows, and ``user_item_window_at`` gives one window.
    """
    return single_windows(user_item_runs(clicks, window, slide, width), slide)


def user_item_window_at(
    clicks: DataFrame,
    end: datetime | None,
    window: str = WINDOW,
    width: int = PIECE_WIDTH,
) -> DataFrame:
    """The one window ending before ``end``: ``user_id, piece, clicks``.

    The bounds are literals, so they reach the scan as pushed filters, and each
    click is used once. Users without clicks in the window have no row.
    """
    upper = F.lit(end).cast("timestamp")
    lower = upper - F.expr(f"INTERVAL {window}")
    inside = clicks.where((F.col("ts") >= lower) & (F.col("ts") < upper))
    return collect_by_range(
        inside, ["user_id"], "item", "clicks", F.struct("ts", "item"), width, distinct=True
    )


def newest_window_end(clicks: DataFrame, slide: str = SLIDE) -> datetime | None:
    """End of the newest window that is not later than a slide after the last click; None without clicks."""
    last = clicks.agg(F.max("ts").alias("ts"))
    newest = last.select(F.window("ts", slide)["end"].alias("end")).first()
    return newest and newest["end"]


def offset_ranges(records: DataFrame) -> DataFrame:
    """Consumed range per topic partition: first offset, offset after the last, and rows."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count("*").alias("n"),
    )
