import hashlib

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import sampling


def digest(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.fixture
def vectors(spark):
    """A third of the rows in one stratum."""
    return spark.range(3000).select(
        F.col("id").alias("qid"),
        F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 5).cast("int") * 50_000).alias("lx"),
        (F.col("id") % 17).cast("int").alias("hs"),
    )


def test_uniform_sample_by_brute_force(vectors):
    got = sorted(r["qid"] for r in sampling.uniform_sample(vectors, 20, "qid").collect())
    assert got == sorted(sorted(range(3000), key=lambda i: (digest(i), i))[:20])
    other = sampling.uniform_sample(vectors, 20, "qid", seed=7).collect()
    assert sorted(r["qid"] for r in other) != got


@pytest.mark.parametrize("salts", [1, 64])
def test_stratified_sample_by_brute_force(vectors, salts):
    rows = vectors.collect()
    expected = set()
    for lx in {r["lx"] for r in rows}:
        members = sorted((r["qid"] for r in rows if r["lx"] == lx), key=lambda i: (digest(i), i))
        expected |= {(lx, q) for q in members[:4]}
    sample = sampling.stratified_sample(vectors, "lx", 4, "qid", salts=salts)
    assert {(r["lx"], r["qid"]) for r in sample.collect()} == expected


def test_losers_are_dropped_before_the_shuffle(vectors, plan_of):
    plan = plan_of(sampling.stratified_sample(vectors, "lx", 4, "qid"))
    assert plan.count("WindowGroupLimit") >= 4


def test_start_centers(vectors):
    tags = ["a", "b", "c", "d", "e"]
    centers = sampling.sample_centers(vectors, 10, tags, 50_000)
    assert [x for x, _ in centers] == [i * 50_000 for i in range(5) for _ in range(2)]
    assert len(sampling.sample_centers(vectors, 10, tags, 100)) == 10
    with pytest.raises(ValueError, match="multiple"):
        sampling.sample_centers(vectors, 11, tags, 50_000)
    with pytest.raises(ValueError, match="needed"):
        sampling.sample_centers(vectors.where("qid < 20"), 25, tags, 50_000)
