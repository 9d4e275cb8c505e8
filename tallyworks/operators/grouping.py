"""Building blocks for large groups: bounded collections and exact medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Numbers that one piece of a group covers.
PIECE_WIDTH = 100_000

# Size parameter of quantile sketches, and the share of a group's rows that the rank of an
# answer may be off by: more than twice what sketches of that size keep to in 99 of 100 cases.
SKETCH_SIZE = 800
SKETCH_RANK_ERROR = 0.01


def range_piece(number: Column, width: int = PIECE_WIDTH) -> Column:
    """Which range of ``width`` consecutive numbers ``number`` lies in, rounded down."""
    wide = number.cast("long")
    return F.call_function("div", wide - F.pmod(wide, F.lit(width).cast("long")), F.lit(width).cast("long"))


def collect_by_range(
    rows: DataFrame,
    keys: list[str],
    number: str,
    name: str,
    element: Column | None = None,
    width: int = PIECE_WIDTH,
    distinct: bool = False,
) -> DataFrame:
    """Sorted arrays of ``element`` per key and range of ``number``: ``*keys, piece, name``.

    The piece depends on the number alone, not on how many rows a key has, so no
    sizes are needed first: one scan and one shuffle, by key and piece. A hot
    key is as many groups as its numbers have ranges, and a group holds no more
    than ``width`` distinct numbers. Where rows are already partitioned by some
    of the keys, collect before joining them with anything else.
    """
    collect = F.collect_set if distinct else F.collect_list
    element = F.col(number) if element is None else element
    piece = range_piece(F.col(number), width).alias("piece")
    return rows.groupBy(*keys, piece).agg(F.sort_array(collect(element)).alias(name))


def whole_lists(pieces: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The pieces of each key put together: ``*keys, piece, name``, one sorted array per key, its ``piece`` 0.

    For results that are one collection per key. Hot keys are collected (and repeats dropped) piece by piece
    before, so that only the finished arrays meet here; a row then has to hold all of its key.
    """
    whole = F.sort_array(F.flatten(F.collect_list(name)))
    return pieces.groupBy(*keys).agg(whole.alias(name)).select(*keys, F.lit(0).alias("piece"), name)


def integer_median(
    rows: DataFrame, keys: list[str], value: str, weight: str | None = None
) -> DataFrame:
    """Exact median of a 32-bit integer column per key, with its own rule for even counts.

    The middle value, or for an even count the mean of the two middle values
    truncated toward zero. Counts per distinct value are combined on the map
    side; then the ranks are located among the upper 16 bits, and only inside
    the one or two buckets that hold them among the lower 16. No window
    partition is longer than 65,536 rows, however many rows a key has.
    """
    amount = F.col(weight) if weight else F.lit(1)
    counts = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("int").alias("_value"))
        .agg(F.sum(amount).cast("long").alias("_n"))
    )
    by_bucket = counts.groupBy(*keys, F.shiftright("_value", 16).alias("_bucket")).agg(
        F.sum("_n").alias("_n")
    )
    running = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy(*keys)
    buckets = by_bucket.select(
        *keys,
        "_bucket",
        F.sum("_n").over(running).alias("_upto"),
        (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )
    # 1-based ranks of the lower and upper middle
    middle = buckets.select(
        *keys,
        "_bucket",
        "_upto",
        "_before",
        F.explode(F.array(F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1"))).alias("_rank"),
    ).where((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    wanted = middle.groupBy(*keys, "_bucket", "_before").agg(
        F.min("_rank").alias("_low"), F.max("_rank").alias("_high")
    )

    inside = Window.partitionBy(*keys, "_bucket").orderBy("_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    located = (
        counts.withColumn("_bucket", F.shiftright("_value", 16))
        .join(wanted, [*keys, "_bucket"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_from", F.col("_upto") - F.col("_n"))
    )

    def value_at(rank: str) -> Column:
        holds = (F.col("_from") < F.col(rank)) & (F.col(rank) <= F.col("_upto"))
        return F.when(holds, F.col("_value").cast("long"))

    # When the two middles lie in two buckets, each bucket knows one rank only:
    # the smaller value found is then the lower middle, the larger one the upper.
    return (
        located.groupBy(*keys)
        .agg(F.min(value_at("_low")).alias("_lower"), F.max(value_at("_high")).alias("_upper"))
        .select(*keys, F.expr("int((_lower + _upper) div 2)").alias("median"))
    )


def quantile_sketches(rows: DataFrame, keys: list[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """A quantile summary ``sketch`` of a whole-number column per key: some kilobytes, however many rows a key has.

    An option for very large groups, or for groups that grow: tasks combine
    their rows before the shuffle, sketches of separate days or files can be
    stored and merged later, and no row is read twice. ``integer_median`` stays
    the exact form. Null values do not count; a key with nulls only has no row.
    """
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), size).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """One ``sketch`` per key out of those of its parts, in any order and grouping."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", size).alias("sketch"))


def sketch_quantile(sketch: Column, share: float = 0.5) -> Column:
    """A value of the group whose rank is near ``share`` of its rows."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(share)))


def rank_errors(rows: DataFrame, answers: DataFrame, keys: list[str], value: str, answer: str, share: float = 0.5) -> DataFrame:
    """``*keys, n, rank_error``: how far the rank of each key's ``answer`` is from ``share`` of its rows, exactly.

    Equal values take a range of ranks; an answer whose range holds the rank asked for has no error.
    The counts are combined on the map side. Keys match when both are null.
    """
    named = answers.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(answer).alias("_answer"))
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    held = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value")).join(named, same)
    counts = held.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("_value") < F.col("_answer")).alias("_below"),
        F.count_if(F.col("_value") <= F.col("_answer")).alias("_upto"),
    )
    wanted = F.lit(float(share)) * F.col("n")
    off = F.greatest(F.col("_below") - wanted, wanted - F.col("_upto"), F.lit(0.0)) / F.col("n")
    return counts.select(*keys, "n", off.alias("rank_error"))
