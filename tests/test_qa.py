import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyworks.operators import qa

LINES = [
    "1,100,,,5,Java",
    "1,200,,,3,C#",
    "1,300,,,0,Scala",
    "1,400,402,,1,Cobol",
    "2,101,,100,7",
    "2,102,,100,-2",
    "2,201,,200,-9",
    "2,401,,400,4",
    "2,901,,999,4",
]


@pytest.fixture
def postings(spark):
    return qa.parse_postings(spark.createDataFrame([(v,) for v in LINES], "value STRING"))


def test_parse(postings):
    rows = {r["id"]: r for r in postings.collect()}
    assert tuple(rows[100]) == (1, 100, None, None, 5, "Java")
    assert tuple(rows[400]) == (1, 400, 402, None, 1, "Cobol")
    assert tuple(rows[102]) == (2, 102, None, 100, -2, None)
    assert dict(postings.dtypes)["id"] == "bigint"


@pytest.mark.parametrize("line", ["x,1,,,1", "1,y,,,1", "1,2,z,,1", "2,3,,p,1", "1,2", "1,2,,,"])
def test_malformed_records(spark, line):
    lines = spark.createDataFrame([(line,), (LINES[0],)], "value STRING")
    with pytest.raises(PySparkException, match="bad posting"):
        qa.parse_postings(lines).collect()
    assert [r["id"] for r in qa.parse_postings(lines, mode="permissive").collect()] == [100]
    assert [r["value"] for r in qa.malformed_postings(lines).collect()] == [line]


def test_pairs(postings):
    pairs = sorted((r["qid"], r["answer_id"]) for r in qa.question_answer_pairs(postings).collect())
    assert pairs == [(100, 101), (100, 102), (200, 201), (400, 401)]


def test_counts_and_groups(postings):
    assert dict(qa.answer_counts(postings).collect()) == {100: 2, 200: 1, 400: 1}
    groups = {r["qid"]: [a["answer_id"] for a in r["answers"]] for r in qa.answers_by_question(postings).collect()}
    assert groups == {100: [101, 102], 200: [201], 400: [401]}


def test_best_score_is_at_least_zero(postings):
    best = {r["qid"]: (r["tag"], r["high_score"]) for r in qa.best_answer_scores(postings).collect()}
    assert best == {100: ("Java", 7), 200: ("C#", 0), 400: ("Cobol", 4)}


def test_vectors(postings):
    scored = qa.best_answer_scores(postings)
    expected = [(100, 50_000, 7), (200, 200_000, 0)]
    assert sorted(tuple(r) for r in qa.feature_vectors(scored).collect()) == expected
    assert sorted(tuple(r) for r in qa.vectors_from_postings(postings).collect()) == expected
    assert dict(qa.unknown_tags(scored).collect()) == {"Cobol": 1}
    with pytest.raises(PySparkException, match="bad tag: Cobol"):
        qa.feature_vectors(scored, strict=True).collect()


def hot_postings(spark, answers=20_000):
    """One question holds nearly all answers."""
    asked = spark.range(1, 11).select(
        F.lit(1).alias("post_type"), "id", F.lit(None).cast("long").alias("parent_id"),
        F.lit(0).alias("score"), F.lit("Java").alias("tag"),
    )
    given = spark.range(100, 100 + answers).select(
        F.lit(2).alias("post_type"), "id",
        F.when(F.col("id") % 100 == 0, F.col("id") % 10 + 1).otherwise(1).alias("parent_id"),
        (F.col("id") % 1000).cast("int").alias("score"), F.lit(None).cast("string").alias("tag"),
    )
    return asked.unionByName(given)


def test_hot_question_is_whole_and_in_bounded_pieces(spark):
    rows = qa.answers_by_question(hot_postings(spark), width=1000).collect()
    assert max(len(r["answers"]) for r in rows) <= 1000
    ids = [a["answer_id"] for r in rows for a in r["answers"]]
    assert len(ids) == 20_000 and len(set(ids)) == 20_000


def test_answers_are_combined_before_the_shuffle(spark, plan_of):
    plan = plan_of(qa.best_answer_scores(hot_postings(spark)))
    assert "partial_max" in plan
    one_pass = plan_of(qa.vectors_from_postings(hot_postings(spark)))
    assert "Join" not in one_pass and "SortAggregate" not in one_pass
    assert one_pass.count(": Exchange") <= 1 or one_pass.count("hashpartitioning") == 1


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_hot(spark, tmp_path, with_settings):
    """Many answers to one question, and no broadcasts."""
    path = str(tmp_path / "hot")
    hot_postings(spark, 60_000).write.parquet(path)
    with_settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    return spark.read.parquet(path)


def test_hot_question_is_split_in_the_pair_join(stored_hot):
    pairs = qa.question_answer_pairs(stored_hot)
    assert len(pairs.collect()) == 60_000
    assert "skew=true" in executed(pairs)


def test_answers_are_collected_before_they_meet_their_question(stored_hot):
    lists = qa.answers_by_question(stored_hot, width=1000)
    rows = lists.collect()
    assert len({a["answer_id"] for r in rows for a in r["answers"]}) == 60_000
    assert max(len(r["answers"]) for r in rows) <= 1000
    plan = executed(lists)
    assert "hashpartitioning(qid" in plan and "piece" in plan[plan.index("ObjectHashAggregate") :]
    assert qa.answers_by_question(stored_hot.where("post_type = 2")).count() == 0
