"""Nearest neighbours by a few stable projections, a k-d tree over them, and a chi-square stopping test.

Projections on m Gaussian directions keep distances up to a factor whose square, for each pair, has the
chi-square distribution with m degrees of freedom. So neighbours are taken in the order of
their projected distance, from a k-d tree over the projections, and verified on the
original vectors, until a point as near as the k-th best found would, with probability
``confidence``, have come up already.

There is one tree over the table. Its upper levels are cut on a bounded sample of projections and
deal all rows to cells, each with the box of its own points; a cell's lower levels are built in the task
that holds it. A query goes to its own cell first, and then, with the limit that the test sets
there, to those cells only whose box reaches into the limit.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.session import materialize

NEIGHBOURS = 10
PROJECTIONS = 8  # even, for the closed form of the distribution
CONFIDENCE = 0.98
LEAF_ROWS = 64
SEED = 20

# Room in squared projected distances for rounding between equal points.
ROUNDING = 1e-12

# Rows and queries that a task holds.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048

# The upper levels are cut on about so many projected rows, and cells have so many of them at least.
SAMPLE_ROWS, LEAST_OF_CELL = 100_000, 16


def chi_square_below(x: float, degrees: int) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_below(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, degrees) < p else (low, middle)
    return high


@cache
def directions(dimension: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, projections))


class KdTree:
    """Boxes of points, halved at the median of their widest side down to leaves; any ties are fine."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(points))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._add(points, 0, len(points), leaf_rows)

    def _add(self, points: np.ndarray, begin: int, end: int, leaf_rows: int) -> int:
        own = points[self.order[begin:end]]
        node = len(self.span)
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.span.append((begin, end))
        self.children.append(None)
        if end - begin > leaf_rows:
            side = int(np.argmax(self.high[node] - self.low[node]))
            half = (end - begin) // 2
            self.order[begin:end] = self.order[begin:end][np.argpartition(own[:, side], half)]
            self.children[node] = (self._add(points, begin, begin + half, leaf_rows), self._add(points, begin + half, end, leaf_rows))
        return node

    def bound(self, node: int, point: np.ndarray) -> float:
        """The least squared distance that a point of the node can have."""
        off = np.maximum(np.maximum(self.low[node] - point, point - self.high[node]), 0)
        return float(off @ off)

    def nearest_first(self, point: np.ndarray):
        """Leaves with their bounds, nearest first."""
        waiting = [(self.bound(0, point), 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if self.children[node] is None:
                yield bound, self.order[slice(*self.span[node])]
            else:
                for child in self.children[node]:
                    heapq.heappush(waiting, (self.bound(child, point), child))


class Cells:
    """The upper levels of the tree: halves at the median of the widest side, cut on a sample. Any point has a cell."""

    def __init__(self, sample: np.ndarray, rows_of_cell: float, first: int = 0):
        self.side: list[int] = []
        self.cut: list[float] = []
        self.children: list[list[int]] = []  # a cell's number c stands as -1 - c
        self.first = self.end = first
        self._add(np.nan_to_num(sample), max(rows_of_cell, LEAST_OF_CELL))

    def _add(self, points: np.ndarray, rows_of_cell: float) -> int:
        widths = points.max(axis=0) - points.min(axis=0)
        side = int(np.argmax(widths))
        if len(points) < 2 * rows_of_cell or not widths[side] > 0:
            self.end += 1
            return -self.end
        values = points[:, side]
        cut = np.partition(values, len(values) // 2)[len(values) // 2]
        if cut == values.max():  # many equal ones: both sides get points
            cut = values[values < cut].max()
        node = len(self.side)
        self.side.append(side)
        self.cut.append(float(cut))
        self.children.append([])
        self.children[node] = [self._add(points[values <= cut], rows_of_cell), self._add(points[values > cut], rows_of_cell)]
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cells of points."""
        points = np.nan_to_num(points)
        if not self.side:
            return np.full(len(points), self.first)
        side, cut, children = np.array(self.side), np.array(self.cut), np.array(self.children)
        at = np.zeros(len(points), np.int64)
        inside = np.arange(len(points))
        while len(inside):
            node = at[inside]
            at[inside] = children[node, (points[inside, side[node]] > cut[node]).astype(int)]
            inside = inside[at[inside] >= 0]
        return -1 - at


def squares_to_boxes(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least squared distance that a point of each box can have."""
    off = np.maximum(np.maximum(low - point, point - high), 0)
    return np.einsum("ij,ij->i", off, off)


class BlockIndex:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray):
        self.ids, self.vectors, self.projected = ids, vectors, projected
        self.tree = KdTree(self.projected)

    def search(self, query_id: int, query: np.ndarray, point: np.ndarray, k: int, ratio: float, limit: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, ties by id.

        ``ratio`` is the quantile of the stopping test, ``limit`` the squared projected distance at which it stops from the start.
        """
        ids, squares = np.empty(0, np.int64), np.empty(0)
        for bound, rows in self.tree.nearest_first(point):
            if bound > limit:
                break
            off = self.projected[rows] - point
            rows = rows[~(np.einsum("ij,ij->i", off, off) > limit)]
            rows = rows[self.ids[rows] != query_id]
            if not len(rows):
                continue
            away = self.vectors[rows] - query
            ids = np.concatenate((ids, self.ids[rows]))
            squares = np.concatenate((squares, np.einsum("ij,ij->i", away, away)))
            best = np.lexsort((ids, squares))[:k]
            ids, squares = ids[best], squares[best]
            if len(ids) == k:
                limit = min(limit, ratio * squares[-1] + ROUNDING)
        return ids, np.sqrt(squares)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _with_points(vectors: DataFrame, projections: int, cells: dict[int, Cells]) -> DataFrame:
    """``vectors`` with ``point``, the projection, and ``cell``, which is -1 for lengths that ``cells`` doesn't have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            points, numbers = np.empty((batch.num_rows, projections)), np.full(batch.num_rows, -1, np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                values = column.take(pa.array(rows)).flatten().to_numpy().astype(np.float64).reshape(-1, length)
                points[rows] = values @ directions(int(length), projections)
                if length in cells:
                    numbers[rows] = cells[length].of(points[rows])
            ends = pa.array(np.arange(0, points.size + 1, projections, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(points.ravel())), pa.array(numbers)], [*batch.schema.names, "point", "cell"]
            )

    schema = T.StructType([*vectors.schema.fields, T.StructField("point", T.ArrayType(T.DoubleType())), T.StructField("cell", T.LongType())])
    return vectors.mapInArrow(run, schema)


def fit_cells(vectors: DataFrame, projections: int, rows_of_cell: int, sample_rows: int = SAMPLE_ROWS) -> dict[int, Cells]:
    """Cells for each length of ``vectors(length, embedding)`` that a random sample of about ``sample_rows`` holds."""
    share = min(1.0, sample_rows / max(1, vectors.count()))
    sample = _with_points(vectors.select("length", "embedding").sample(share, SEED), projections, {})
    sample = sample.select("length", *[F.get("point", i).alias(f"p{i}") for i in range(projections)]).toPandas()
    found: dict[int, Cells] = {}
    first = 0
    for length, rows in sample.groupby("length"):
        found[int(length)] = Cells(rows.drop(columns="length").to_numpy(), rows_of_cell * share, first)
        first = found[int(length)].end
    return found


def _searched(data: DataFrame, asked: DataFrame, visits: DataFrame, k: int, ratio: float, block_queries: int) -> DataFrame:
    """``query_id, length, vec_id, score``: what queries find at the places of ``visits(vec_id, length, cell, piece, limit)``."""
    place = ["length", "cell", "piece"]
    visits = materialize(visits, "visits")
    # A place that many queries come to is held by several tasks, each with a part of the queries.
    parts = visits.groupBy(*place).agg(F.ceil(F.count("*") / F.lit(block_queries)).cast("int").alias("parts"))
    held = data.join(parts, place).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    coming = visits.join(parts, place).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    coming = coming.join(asked.select("vec_id", "length", "embedding", "point"), ["vec_id", "length"])

    def search(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(queries):
            vectors, points = (np.stack(own[c].to_list()).astype(np.float64) for c in ("embedding", "point"))
            index = BlockIndex(own["vec_id"].to_numpy(), vectors, points)
            for q in queries.itertuples():
                query, point = np.asarray(q.embedding, np.float64), np.asarray(q.point, np.float64)
                ids, scores = index.search(q.vec_id, query, point, k, ratio, q.limit)
                found.append(pd.DataFrame({"query_id": q.vec_id, "length": q.length, "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "length": [], "vec_id": [], "score": []})

    key = [*place, "part"]
    held = held.select(*key, "vec_id", "embedding", "point")
    coming = coming.select(*key, "vec_id", "embedding", "point", "limit")
    return held.groupBy(*key).cogroup(coming.groupBy(*key)).applyInPandas(search, "query_id long, length int, vec_id long, score double")


def _reached(asked: DataFrame, boxes: pd.DataFrame, projections: int) -> DataFrame:
    """``vec_id, length, limit, cell`` for each cell whose box reaches into a query's limit; cell -1 always does."""
    held = {
        int(length): (rows["cell"].to_numpy(), *(rows[[f"{side}{i}" for i in range(projections)]].to_numpy() for side in ("low", "high")))
        for length, rows in boxes.groupby("length")
    }

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for length, own, point, limit in zip(part["length"], part["cell"], part["point"], part["limit"]):
                if own < 0:
                    found.append(np.array([own]))
                else:
                    cells, low, high = held[length]
                    found.append(cells[~(squares_to_boxes(np.asarray(point), low, high) > limit)])
            yield pd.DataFrame({"vec_id": part["vec_id"], "length": part["length"], "limit": part["limit"], "cell": found})

    reached = asked.select("vec_id", "length", "cell", "point", "limit").mapInPandas(run, "vec_id long, length int, limit double, cell array<long>")
    return reached.withColumn("cell", F.explode("cell"))


def nearest_neighbours(
    rows: DataFrame,
    queries: Column,
    k: int = NEIGHBOURS,
    projections: int = PROJECTIONS,
    confidence: float = CONFIDENCE,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each row that ``queries`` selects.

    ``score`` is the Euclidean distance in double precision; equal ones are
    ranked by the smaller id. A query's own id is no candidate. Vectors that are
    null, zero, or hold null or non-finite components take no part, nor do rows without an id;
    vectors are only compared with those of equal length. A repeated row is a candidate
    of its own; of repeated queries the smallest vector is searched. With fewer candidates all are
    returned; other columns are not read; an empty table gives an empty result. A very long vector is
    held whole, ``block_rows`` of its length at a time. Distances beyond the range of doubles are infinite.

    A true neighbour is missed with a probability of at most ``1 - confidence``. A cell of more than ``block_rows``
    rows, as copies of one vector make it, is held in several pieces. The driver sees the sample and a box for each cell.
    """
    given = rows.schema["embedding"].dataType
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    vector = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"), queries.alias("asked"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("length", F.size("embedding"))
    ratio = chi_square_quantile(confidence, projections)

    cells = fit_cells(vectors, projections, block_rows)
    dealt = F.shiftright(F.xxhash64(F.monotonically_increasing_id()), 33)
    placed = materialize(_with_points(vectors, projections, cells).withColumn("dealt", dealt), "cells")
    place = ["length", "cell"]
    ends = [f(F.get("point", i)).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(projections)]
    sizes = placed.groupBy(*place).agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("pieces"), *ends)
    sizes = materialize(sizes, "boxes")
    boxes = sizes.where("cell >= 0").toPandas()
    pieces = sizes.select(*place, "pieces")
    data = placed.join(pieces, place).withColumn("piece", F.pmod("dealt", F.col("pieces")).cast("int"))

    asked = placed.where("asked").groupBy("vec_id", "length").agg(F.min(F.struct("embedding", "point", "cell")).alias("row"))
    asked = materialize(asked.select("vec_id", "length", "row.*"), "queries")
    own = asked.join(pieces, place).withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int"))
    own = own.select("vec_id", *place, "piece", F.lit(math.inf).alias("limit"))
    near = materialize(_searched(data, asked, own, k, ratio, block_queries), "near")

    full = near.groupBy(F.col("query_id").alias("vec_id"), "length").agg(F.count("*").alias("n"), F.max("score").alias("last"))
    full = full.where(F.col("n") >= k).select("vec_id", "length", (F.col("last") * F.col("last") * ratio + ROUNDING).alias("limit"))
    limited = asked.join(full, ["vec_id", "length"], "left").withColumn("limit", F.coalesce("limit", F.lit(math.inf)))
    further = _reached(limited, boxes, projections).join(pieces, place).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    further = further.select("vec_id", *place, "piece", "limit").join(own.drop("limit"), ["vec_id", *place, "piece"], "left_anti")
    best = near.unionByName(_searched(data, asked, further, k, ratio, block_queries))

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
