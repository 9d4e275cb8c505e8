import random
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.operators.grouping import (
    SKETCH_RANK_ERROR,
    collect_by_range,
    integer_median,
    merge_sketches,
    quantile_sketches,
    range_piece,
    rank_errors,
    sketch_quantile,
)


def truncated_median(values):
    ordered = sorted(values)
    low, high = ordered[(len(ordered) - 1) // 2], ordered[len(ordered) // 2]
    return int((low + high) / 2)


def medians(spark, groups):
    rows = [(key, v) for key, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k STRING, v INT")
    return dict(integer_median(df, ["k"], "v").collect())


def test_median_by_brute_force(spark):
    rng = random.Random(7)
    groups = {
        "one": [5],
        "pair": [1, 4],
        "negative pair": [-4, -1],
        "around zero": [-1, 0],
        "far apart": [-2_000_000_000, 2_000_000_000, 70_000, 3],
        "bucket edge": [65_535, 65_536],
        "same": [9] * 1000,
        "wide": [rng.randint(-(2**31), 2**31 - 1) for _ in range(2001)],
        "narrow": [rng.randint(0, 30) for _ in range(3000)],
    }
    assert medians(spark, groups) == {k: truncated_median(v) for k, v in groups.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.sampled_from("abc"),
        st.lists(st.integers(-200_000, 200_000), min_size=1, max_size=40),
        min_size=1,
    )
)
def test_median_of_any_groups(spark, groups):
    assert medians(spark, groups) == {k: truncated_median(v) for k, v in groups.items()}


def test_weighted_median(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 50, 1), ("a", 90, 12)], "k STRING, v INT, n LONG")
    expected = statistics.median([1] * 10 + [50] + [90] * 12)
    assert integer_median(df, ["k"], "v", "n").first()["median"] == expected


def test_null_values_do_not_count(spark):
    df = spark.createDataFrame([("a", None), ("a", 3)], "k STRING, v INT")
    assert integer_median(df, ["k"], "v").first()["median"] == 3


def test_ranges_of_any_number(spark):
    numbers = [0, 1, 9, 10, -1, -10, -11, 2**63 - 1, -(2**63) + 10]
    df = spark.createDataFrame([(n,) for n in numbers], "n LONG")
    assert [r[0] for r in df.select(range_piece(F.col("n"), 10)).collect()] == [n // 10 for n in numbers]


def test_pieces_are_whole_and_follow_the_number_alone(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 > 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 90).cast("string")))
        .alias("k"),
        (F.col("id") - 4500).alias("v"),
    )
    got = collect_by_range(rows, ["k"], "v", "vs", width=500).collect()
    assert sorted(v for r in got for v in r["vs"]) == list(range(-4500, 4500))
    assert all(v // 500 == r["piece"] for r in got for v in r["vs"])
    assert all(r["vs"] == sorted(r["vs"]) for r in got)
    assert len({(r["k"], r["piece"]) for r in got}) == len(got) == 31 * 18


def test_repeats_and_other_elements(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 3, "y")], "k STRING, v INT, e STRING")
    assert [r["vs"] for r in collect_by_range(rows, ["k"], "v", "vs").collect()] == [[1, 1, 3]]
    assert [r["es"] for r in collect_by_range(rows, ["k"], "v", "es", F.col("e"), distinct=True).collect()] == [["x", "y"]]


def test_one_shuffle_spreads_a_hot_key(spark, tmp_path, with_settings):
    path = str(tmp_path / "hot")
    spark.range(60_000).select(
        F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(0).alias("k"), F.col("id").alias("v")
    ).write.parquet(path)
    with_settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    lists = collect_by_range(spark.read.parquet(path), ["k"], "v", "vs", width=1000)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "Join" not in plan
    shares = lists.select(F.size("vs").alias("n")).groupBy(F.spark_partition_id()).sum("n").collect()
    assert len(shares) == 8 and max(r[1] for r in shares) < 20_000
    rows = lists.collect()
    assert sorted(v for r in rows for v in r["vs"]) == list(range(60_000))
    assert max(len(r["vs"]) for r in rows) <= 1000


def sketched(spark, groups, share=0.5):
    """Rows with a part, and the answers of sketches by part that are merged."""
    rows = [(key, i % 7, v) for key, values in groups.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k STRING, part INT, v INT")
    merged = merge_sketches(quantile_sketches(df, ["k", "part"], "v"), ["k"])
    return df, merged.select("k", sketch_quantile(F.col("sketch"), share).alias("near"))


def test_merged_sketches_keep_the_bound(spark):
    rng = random.Random(11)
    groups = {
        "uniform": [rng.randint(-(2**31), 2**31 - 1) for _ in range(20_000)],
        "sorted": list(range(20_000)),
        "few values": [rng.choice([1, 5, 5, 9]) for _ in range(9000)],
        "skewed": [int(rng.paretovariate(0.6)) % 2**31 for _ in range(9000)],
        "same": [4] * 3000,
        "one": [-3],
        None: list(range(500)),
    }
    for share in (0.05, 0.5, 0.99):
        df, answers = sketched(spark, groups, share)
        near = {r["k"]: r["near"] for r in answers.collect()}
        assert all(near[k] in values for k, values in groups.items())
        for key, values in groups.items():
            below, upto = sum(v < near[key] for v in values), sum(v <= near[key] for v in values)
            assert max(below - share * len(values), share * len(values) - upto, 0) <= SKETCH_RANK_ERROR * len(values) + 1
        assert near["same"] == 4 and near["one"] == -3


def test_rank_errors_by_hand(spark):
    rows = spark.createDataFrame([(k, v) for k in ("a", None) for v in (1, 2, 2, 9, None)], "k STRING, v INT")
    answers = spark.createDataFrame([("a", 9), (None, 2)], "k STRING, near INT")
    errors = {r["k"]: (r["n"], r["rank_error"]) for r in rank_errors(rows, answers, ["k"], "v", "near").collect()}
    assert errors == {"a": (4, 0.25), None: (4, 0.0)}


def test_sketches_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("b", 3)], "k STRING, v INT")
    sketches = quantile_sketches(df, ["k"], "v")
    assert [tuple(r) for r in sketches.select("k", sketch_quantile(F.col("sketch"))).collect()] == [("b", 3)]
    assert merge_sketches(quantile_sketches(df.limit(0), ["k"], "v"), ["k"]).collect() == []


def test_sketches_are_combined_before_the_shuffle(spark, plan_of, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id % 3 AS k", "id % 5 AS part", "int(id) AS v").write.parquet(path)
    plan = plan_of(merge_sketches(quantile_sketches(spark.read.parquet(path), ["k", "part"], "v"), ["k"]))
    assert plan.count("partial_kll") == 2 and "EvalPython" not in plan
