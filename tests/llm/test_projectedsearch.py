import math

import numpy as np
from pyspark.sql import functions as F

from tallyworks.llm import projectedsearch as ps


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, asked, k):
    vectors = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows}
    out = {}
    for q in asked:
        scores = sorted((float(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())), i) for i in vectors if i != q)
        out[q] = scores[:k]
    return out


def test_recall_and_distances(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(20, 32))
    rows = [(i, (centers[i % 20] + rng.normal(size=32) * 0.4).tolist(), 0) for i in range(3000)]
    found = ps.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, block_rows=700, block_queries=25).collect()
    want = brute(rows, range(0, 3000, 50), 10)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    exact = {(q, i): s for q in want for s, i in want[q]}
    assert all(abs(exact[q, i] - s) < 1e-9 for q in got for s, i in got[q] if (q, i) in exact)
    assert all(list(v) == sorted(v) for v in got.values())


def test_ties_and_copies_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(200)] + [(500, [1.0, 2.0, 4.0], 0)]
    found = ps.nearest_neighbours(frame(spark, rows), F.col("vec_id").isin(100, 500)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(100, i + 1, i, 0.0) for i in range(10)] + [(500, i + 1, i, 1.0) for i in range(10)]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, None, 0), (2, [0.0, 0.0], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0), (5, [None, 1.0], 0), (6, [], 0)]
    rows += [(7, [1.0, 1.0], 0), (8, [1.0, 1.0, 1.0], 0), (None, [1.0, 0.0], 0), (7, [1.0, 1.0], 0), (50, [2.0, 0.0], 0), (100, [0.0, 0.0], 0)]
    df = frame(spark, rows).withColumn("rank", F.lit(1)).withColumn("length", F.lit("x"))
    found = ps.nearest_neighbours(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in found] == [(0, 7, 1.0), (0, 7, 1.0), (0, 50, 1.0), (50, 0, 1.0), (50, 7, math.sqrt(2)), (50, 7, math.sqrt(2))]


def test_empty_table(spark):
    assert ps.nearest_neighbours(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_a_hot_cell_is_held_in_pieces(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist(), 0) for i in range(1200)]
    found = ps.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, block_rows=60, block_queries=5).collect()
    want = brute(rows, range(0, 1200, 50), 10)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert all(got[q] == [(0.0, i) for _, i in want[q]] for q in want if q % 3 == 0)
    assert sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want) >= 0.95 * 10 * len(want)


def test_huge_components(spark):
    rows = [(0, [1e38, 1.0], 0), (1, [-3e38, 1.0], 0), (2, [1.0, 1.0], 0)]
    wide = frame(spark, rows).withColumn("embedding", F.expr("transform(embedding, x -> CAST(x AS DOUBLE) * 1e200)"))
    found = ps.nearest_neighbours(wide, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, math.inf), (2, math.inf)]


def test_cells_take_all_points_and_their_boxes_hold_them():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(5000, 8))
    points[::3] = points[0]
    cells = ps.Cells(points[:2000], 50, first=7)
    numbers = cells.of(points)
    assert numbers.min() == 7 and numbers.max() == cells.end - 1 and len(set(numbers.tolist())) > 16
    for c in set(numbers.tolist()):
        own = points[numbers == c]
        assert (ps.squares_to_boxes(own[0], own.min(axis=0)[None], own.max(axis=0)[None]) == 0).all()


def test_a_query_leaves_most_cells_out():
    """With more rows of the same kind there are more cells, but a query does not go to more of them."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(400, 32))
    ratio, share = ps.chi_square_quantile(ps.CONFIDENCE, ps.PROJECTIONS), []
    for n in (8000, 32000):
        vectors = centers[rng.integers(0, len(centers), n)] + rng.normal(size=(n, 32)) * 0.02
        points = vectors @ ps.directions(32)
        numbers = ps.Cells(points, 250).of(points)
        boxes = [(own.min(axis=0), own.max(axis=0)) for own in (points[numbers == c] for c in np.unique(numbers))]
        low, high = (np.stack(x) for x in zip(*boxes))
        gone = []
        for q in range(50):
            last = np.sort(((vectors[numbers == numbers[q]] - vectors[q]) ** 2).sum(axis=1))[10]
            gone.append((~(ps.squares_to_boxes(points[q], low, high) > ratio * last)).sum())
        share.append((np.mean(gone), len(boxes)))
    assert share[1][1] >= 3.5 * share[0][1] and share[1][0] <= 1.5 * share[0][0] and share[1][0] < 0.1 * share[1][1]


def test_chi_square():
    assert abs(ps.chi_square_below(15.507, 8) - 0.95) < 1e-4
    assert abs(ps.chi_square_quantile(0.95, 8) - 15.507) < 1e-3
