import random

import pytest

from tallyworks.operators import clustering
from tallyworks.session import CHECKPOINT_SETTING

TAGS = ["a", "b", "c"]
SPREAD = 1000


def distance(p, c):
    return (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2


def closest(p, centers):
    return min(range(len(centers)), key=lambda i: (distance(p, centers[i]), i))


def brute_round(points, centers):
    moved = []
    for i, center in enumerate(centers):
        members = [p for p in points if closest(p, centers) == i]
        if not members:
            moved.append(center)
        else:
            moved.append(tuple(int(sum(p[d] for p in members) / len(members)) for d in (0, 1)))
    return moved


def brute_fit(points, centers, eta=20.0, most=120):
    for rounds in range(1, most + 1):
        moved = brute_round(points, centers)
        movement = sum(distance(a, b) for a, b in zip(centers, moved))
        centers = moved
        if movement < eta:
            break
    return centers, rounds, movement


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    return [(rng.randrange(3) * SPREAD, int(rng.paretovariate(0.7))) for _ in range(500)]


@pytest.fixture(scope="module")
def vectors(spark, points):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "qid LONG, lx INT, hs INT")


START = [(0, 0), (0, 50), (0, 900), (1000, 1), (1000, 30), (2000, 2), (2000, 2), (9000, 9000)]


@pytest.mark.parametrize("compiled", [True, False])
def test_assignment_by_brute_force(vectors, compiled):
    for row in clustering.assign_clusters(vectors, START, compiled).collect():
        assert row["ci"] == closest((row["lx"], row["hs"]), START)


def test_many_centers(vectors):
    centers = [(i % 3 * SPREAD, i) for i in range(400)]
    for row in clustering.assign_clusters(vectors, centers).collect():
        assert row["ci"] == closest((row["lx"], row["hs"]), centers)


def test_assignment_stays_in_place(vectors, plan_of):
    plan = plan_of(clustering.assign_clusters(vectors, START))
    assert "Exchange" not in plan and "Join" not in plan and "EvalPython" not in plan


def test_one_round(vectors, points):
    weighted = clustering.weighted_points(vectors)
    assert clustering.move_centers(weighted, START) == brute_round(points, START)
    assert START[7] == clustering.move_centers(weighted, START)[7]


def test_fit(vectors, points):
    fit = clustering.fit_centers(vectors, START)
    assert tuple(fit) == brute_fit(points, START)
    stored = clustering.stored_points(vectors)
    assert clustering.fit_centers(stored, START) == fit
    assert clustering.fit_centers(stored, START, eta=-1.0, max_rounds=2).rounds == 2


def test_points_are_kept_in_the_named_folder(spark, vectors):
    stored = clustering.stored_points(vectors)
    assert all(spark.conf.get(CHECKPOINT_SETTING) in f for f in stored.inputFiles())


def test_means_truncate_toward_zero(spark):
    df = spark.createDataFrame([(0, -1), (0, -2)], "lx INT, hs INT")
    row = clustering.cluster_means(clustering.weighted_points(df), [(0, 0)]).first()
    assert (row["cx"], row["cy"], row["size"]) == (0, -1, 2)


def test_summary_by_brute_force(vectors, points):
    centers = [(0, 0), (1000, 0), (1400, 40), (5000, 0)]
    expected = []
    for i in range(len(centers)):
        members = [p for p in points if closest(p, centers) == i]
        if not members:
            continue
        tags = [x // SPREAD for x, _ in members]
        top = min(set(tags), key=lambda t: (-tags.count(t), t))
        scores = sorted(y for _, y in members)
        middle = (scores[(len(scores) - 1) // 2] + scores[len(scores) // 2]) // 2
        percent = tags.count(top) * 100.0 / len(members)
        expected.append((i, TAGS[top], pytest.approx(percent), len(members), middle))
    expected.sort(key=lambda r: (r[4], r[0]))
    got = [tuple(r) for r in clustering.cluster_summary(vectors, centers, TAGS, SPREAD).collect()]
    assert got == expected


def test_equally_common_tags(spark):
    df = spark.createDataFrame([(1000, 1), (2000, 1)], "lx INT, hs INT")
    row = clustering.cluster_summary(df, [(1500, 1)], TAGS, SPREAD).first()
    assert (row["label"], row["percent"], row["size"], row["median"]) == ("b", 50.0, 2, 1)


def test_report_text(spark, capsys):
    rows = [(0, "Groovy", 100.0, 1631, 0), (1, "C#", 99.96, 361835, 1)]
    summary = spark.createDataFrame(rows, "ci INT, label STRING, percent DOUBLE, size LONG, median INT")
    clustering.print_report(summary)
    assert capsys.readouterr().out.splitlines()[3:] == [
        "      0  Groovy            (100.0%)         1631",
        "      1  C#                (100.0%)       361835",
    ]
