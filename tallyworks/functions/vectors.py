"""Two-dimensional integer vectors as plain columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Center = tuple[int, int]

MAX_UNROLLED = 256


def squared_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Squared Euclidean distance; no root is taken, also not for convergence."""
    dx = ax.cast("double") - bx.cast("double")
    dy = ay.cast("double") - by.cast("double")
    return dx * dx + dy * dy


def nearest_center(x: Column, y: Column, centers: list[Center], compiled: bool = True) -> Column:
    """Index of the nearest of ``centers``; the lowest index wins a tie.

    The centers travel inside the expression, so rows are assigned where they
    lie. ``compiled`` writes the distances out one by one: many times faster per
    row, but Spark compiles it anew for each set of centers. For few rows, or
    very many centers, the distances are taken in a loop over an array instead.
    """
    if compiled and len(centers) <= MAX_UNROLLED:
        distances = F.array(
            *[squared_distance(x, y, F.lit(float(cx)), F.lit(float(cy))) for cx, cy in centers]
        )
    else:
        xs = F.array(*[F.lit(float(cx)) for cx, _ in centers])
        ys = F.array(*[F.lit(float(cy)) for _, cy in centers])
        distances = F.zip_with(xs, ys, lambda cx, cy: squared_distance(x, y, cx, cy))
    return (F.array_position(distances, F.array_min(distances)) - F.lit(1)).cast("int")
