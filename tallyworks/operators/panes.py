"""Sliding windows put together from panes.

A pane is one step of the window. Each click is kept in one pane, whatever the
ratio of window and step. A window's content changes only where a pane comes in at its
front or falls out at its back, so the windows between two such places are one
run with one content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.times import duration_micros
from tallyworks.operators.grouping import PIECE_WIDTH, range_piece


def panes_per_window(window: str, slide: str) -> int:
    """How many steps make a window; it must be a whole number."""
    steps, rest = divmod(duration_micros(window), duration_micros(slide))
    if rest or not steps:
        raise ValueError(f"a window of {window} is no multiple of {slide}")
    return steps


def item_panes(clicks: DataFrame, slide: str, width: int = PIECE_WIDTH) -> DataFrame:
    """The distinct clicks of each step: ``user_id, pane, piece, clicks``, a piece for each ``width`` item numbers.

    Each click is in one row. Over a stream with a watermark on ``ts`` this is a
    stateful aggregate whose rows are bounded by the step and the piece, and
    leave the state when their pane is closed.
    """
    click = F.struct("ts", "item")
    return (
        clicks.groupBy("user_id", F.window("ts", slide).alias("w"), range_piece(F.col("item"), width).alias("piece"))
        .agg(F.sort_array(F.collect_set(click)).alias("clicks"))
        .select("user_id", F.col("w.start").alias("pane"), "piece", "clicks")
    )


def _step_start(step: Column, slide: int) -> Column:
    return F.timestamp_micros(step * F.lit(slide))


def window_runs(panes: DataFrame, window: str, slide: str) -> DataFrame:
    """Windows with clicks, as runs: ``user_id, piece, first_start, last_start, clicks``.

    All windows that start from ``first_start`` to ``last_start``, one step apart, hold
    the same clicks. A user's panes are worked on in blocks of one window's length, a pane
    with its own block and with the one before, where the windows begin that reach into it: so each
    click goes through the shuffle twice at most, and no task holds more than two
    windows' panes of a user and piece. Runs end with their block.
    """
    k, micros = panes_per_window(window, slide), duration_micros(slide)
    step = F.call_function("div", F.unix_micros("pane"), F.lit(micros).cast("long"))
    blocks = F.array_distinct(F.array(range_piece(F.col("step") - (k - 1), k), range_piece(F.col("step"), k)))
    gathered = (
        panes.withColumn("step", step)
        .select("user_id", "piece", F.explode(blocks).alias("block"), F.struct("step", "clicks").alias("pane"))
        .groupBy("user_id", "piece", "block")
        .agg(F.sort_array(F.collect_list("pane")).alias("panes"))
        .withColumn("first_step", F.col("block") * k)
    )
    # steps of the block at which a pane comes in, and those behind the last window with it
    changes = F.concat(
        F.array("first_step"),
        F.transform("panes", lambda p: p["step"] - (k - 1)),
        F.transform("panes", lambda p: p["step"] + 1),
    )
    inside = F.filter(changes, lambda s: s.between(F.col("first_step"), F.col("first_step") + (k - 1)))
    runs = gathered.withColumn("starts", F.array_sort(F.array_distinct(inside)))

    def run(start: Column, at: Column) -> Column:
        held = F.filter("panes", lambda p: p["step"].between(start, start + (k - 1)))
        behind = F.coalesce(F.get("starts", at + 1), F.col("first_step") + k)
        return F.struct(
            start.alias("first"),
            (behind - 1).alias("last"),
            F.flatten(F.transform(held, lambda p: p["clicks"])).alias("clicks"),
        )

    return (
        runs.select("user_id", "piece", F.inline(F.transform("starts", run)))
        .where(F.size("clicks") > 0)
        .select(
            "user_id",
            "piece",
            _step_start(F.col("first"), micros).alias("first_start"),
            _step_start(F.col("last"), micros).alias("last_start"),
            "clicks",
        )
    )


def single_windows(runs: DataFrame, slide: str) -> DataFrame:
    """One row for each window of each run: ``user_id, window_start, piece, clicks``."""
    micros = duration_micros(slide)
    starts = F.sequence(F.unix_micros("first_start"), F.unix_micros("last_start"), F.lit(micros).cast("long"))
    return runs.select("user_id", F.explode(starts).alias("at"), "piece", "clicks").select(
        "user_id", F.timestamp_micros("at").alias("window_start"), "piece", "clicks"
    )
