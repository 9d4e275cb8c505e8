"""Integer k-means over two-dimensional vectors, and cluster summaries."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.vectors import Center, nearest_center
from tallyworks.operators.grouping import integer_median
from tallyworks.session import materialize

# The default parameters of the clustering.
DEFAULT_CLUSTERS = 45
DEFAULT_ETA = 20.0
DEFAULT_MAX_ROUNDS = 120

# The layout of the printed report.
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_LINE = "%7d  %-17s (%-5.1f%%)      %7d"


class Fit(NamedTuple):
    centers: list[Center]
    rounds: int
    movement: float


def weighted_points(vectors: DataFrame) -> DataFrame:
    """Distinct points ``lx, hs`` with the number ``n`` of vectors at each.

    All sums, sizes and medians over the vectors can be taken from these far
    fewer rows without any loss.
    """
    return vectors.groupBy("lx", "hs").agg(F.count("*").alias("n"))


def stored_points(vectors: DataFrame) -> DataFrame:
    """``weighted_points`` as a stored table; weighted points given stay as they are."""
    if "n" in vectors.columns:
        return vectors
    return materialize(weighted_points(vectors), "points")


def assign_clusters(
    vectors: DataFrame, centers: list[Center], compiled: bool = True
) -> DataFrame:
    """The vectors with the index ``ci`` of their nearest center; nothing is shuffled."""
    nearest = nearest_center(F.col("lx"), F.col("hs"), centers, compiled)
    return vectors.withColumn("ci", nearest)


def cluster_means(
    points: DataFrame, centers: list[Center], compiled: bool = True
) -> DataFrame:
    """Truncated mean ``cx, cy`` of each non-empty cluster of weighted points."""
    return (
        assign_clusters(points, centers, compiled)
        .groupBy("ci")
        .agg(
            F.sum(F.col("lx").cast("long") * F.col("n")).alias("_sx"),
            F.sum(F.col("hs").cast("long") * F.col("n")).alias("_sy"),
            F.sum("n").alias("size"),
        )
        .select(
            "ci",
            F.expr("int(_sx div size)").alias("cx"),
            F.expr("int(_sy div size)").alias("cy"),
            "size",
        )
    )


def move_centers(
    points: DataFrame, centers: list[Center], compiled: bool = True
) -> list[Center]:
    """One round; an empty cluster keeps its center. One row per cluster reaches the driver."""
    moved = list(centers)
    for row in cluster_means(points, centers, compiled).collect():
        moved[row["ci"]] = (row["cx"], row["cy"])
    return moved


def total_movement(before: list[Center], after: list[Center]) -> float:
    """Sum of squared distances over all centers."""
    return float(sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(before, after)))


def fit_centers(
    vectors: DataFrame,
    start: list[Center],
    eta: float = DEFAULT_ETA,
    max_rounds: int = DEFAULT_MAX_ROUNDS,
) -> Fit:
    """Move the centers until their total movement is below ``eta``.

    Takes vectors or ``stored_points``. The rounds read the stored points, so
    neither the parsing nor the question-answer shuffle is ever repeated, also
    not after a lost executor. Distinct points are few, so the distances of a
    round are taken in a loop rather than compiled for its centers.
    """
    points = stored_points(vectors)
    centers = [(int(x), int(y)) for x, y in start]
    rounds, movement = 0, float("inf")
    while rounds < max_rounds and not movement < eta:
        moved = move_centers(points, centers, compiled=False)
        movement = total_movement(centers, moved)
        centers = moved
        rounds += 1
    return Fit(centers, rounds, movement)


def centers_frame(vectors: DataFrame, centers: list[Center]) -> DataFrame:
    """The centers as rows ``ci, cx, cy``."""
    return vectors.sparkSession.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(centers)], "ci INT, cx INT, cy INT"
    )


def cluster_summary(
    vectors: DataFrame, centers: list[Center], vocabulary: list[str], spread: int
) -> DataFrame:
    """Per non-empty cluster: most common tag, its share in percent, size and median score.

    Takes vectors or ``stored_points``. Clusters come in order of their median,
    then index. Of equally common tags the first of the vocabulary is taken.
    """
    stored = stored_points(vectors)
    points = assign_clusters(stored, centers, compiled=False)
    sizes = (
        points.groupBy("ci", "lx")
        .agg(F.sum("n").alias("n"))
        .groupBy("ci")
        .agg(
            F.max_by("lx", F.struct(F.col("n"), -F.col("lx"))).alias("_lx"),
            (F.max("n") * F.lit(100.0) / F.sum("n")).alias("percent"),
            F.sum("n").alias("size"),
        )
    )
    tags = F.array(*[F.lit(tag) for tag in vocabulary])
    label = F.element_at(tags, F.expr(f"int(_lx div {int(spread)})") + F.lit(1))
    return (
        sizes.join(integer_median(points, ["ci"], "hs", "n"), "ci")
        .select("ci", label.alias("label"), "percent", "size", "median")
        .orderBy("median", "ci")
    )


def report_lines(summary: DataFrame) -> DataFrame:
    """The summary rows as text ``line``, with their position keys ``median`` and ``ci``."""
    line = F.format_string(REPORT_LINE, "median", "label", "percent", "size")
    return summary.select("median", "ci", line.alias("line"))


def print_report(summary: DataFrame) -> None:
    """Print the report; a summary has one row per cluster."""
    rows = report_lines(summary).orderBy("median", "ci").collect()
    print("\n".join([*REPORT_HEADER, *[row["line"] for row in rows]]))
