import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyworks.operators import timeuse
from tallyworks.sources.files import read_survey, survey_rows


def activity_names(majors):
    return [f"t{major:02d}{minor:02d}01" for major in majors for minor in range(1, 6)]


def test_each_code_belongs_to_its_first_class():
    names = ["tucaseid", "teage", "telfs", *activity_names(range(1, 19)), "t500101"]
    classes = timeuse.classify_columns(names)
    assert {n[:3] for n in classes.primary} == {"t01", "t03", "t11", "t18"}
    assert [n for n in classes.primary if n.startswith("t18")] == ["t180101", "t180301"]
    assert [n for n in classes.work if n.startswith("t18")] == ["t180501"]
    assert [n for n in classes.other if n.startswith("t18")] == ["t180201", "t180401"]
    placed = {*classes.primary, *classes.work, *classes.other}
    assert len(placed) == sum(map(len, classes))
    left = [n for n in names if n not in placed]
    assert left == ["tucaseid", "teage", "telfs", *activity_names([17]), "t500101"]


def test_classes_can_be_given():
    classes = timeuse.classify_columns(["a1", "b1", "c1"], ("a",), ("b",), ("x",))
    assert classes == (["a1"], ["b1"], [])


def test_sum_of_hundreds_of_columns(spark):
    df = spark.range(1).select(*[F.lit(float(i)).alias(f"c{i}") for i in range(400)])
    total = timeuse.sum_columns([F.col(c) for c in df.columns])
    assert df.select(total).first()[0] == sum(range(400))


def test_sum_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([(1.0, None)], "a DOUBLE, b DOUBLE")
    assert df.select(timeuse.sum_columns([F.col("a"), F.col("b")])).first()[0] is None


def test_labels(spark):
    rows = [(telfs, sex, age) for telfs in (1, 2, 3, 4, None) for sex, age in ((1, 15), (2, 22))]
    rows += [(1, 1, a) for a in (14, 23, 55, 56)]
    df = spark.createDataFrame(rows, "telfs INT, tesex INT, teage INT")
    labelled = df.select("*", *timeuse.life_period_columns()).collect()
    for row in labelled:
        assert row["working"] == ("working" if row["telfs"] in (1, 2) else "not working")
        assert row["sex"] == ("male" if row["tesex"] == 1 else "female")
        age = row["teage"]
        assert row["age"] == (
            "young" if 15 <= age <= 22 else "active" if 23 <= age <= 55 else "elder"
        )


SURVEY = [
    (1, 1, 20, 60.0, 120.0, 30.0),
    (2, 1, 21, 120.0, 0.0, 60.0),
    (4, 2, 60, 600.0, 0.0, 90.0),
    (5, 2, 60, 999.0, 999.0, 999.0),
    (None, 1, 30, 1.0, 1.0, 1.0),
    (1, 2, 40, None, 60.0, 60.0),
]


@pytest.fixture
def survey(spark):
    schema = "telfs INT, tesex INT, teage INT, t010101 DOUBLE, t050101 DOUBLE, t020101 DOUBLE"
    return spark.createDataFrame(SURVEY, schema)


def test_averages_by_life_period(survey):
    rows = [tuple(r) for r in timeuse.time_use_by_life_period(survey).collect()]
    assert rows == [
        ("not working", "female", "elder", 10.0, 0.0, 1.5),
        ("working", "female", "active", None, 1.0, 1.0),
        ("working", "male", "young", 1.5, 1.0, 0.8),
    ]


def test_three_forms_agree(survey):
    summary = timeuse.summarize_survey(survey)
    forms = [
        timeuse.time_use_grouped(summary),
        timeuse.time_use_grouped_sql(summary),
        timeuse.time_use_grouped_typed(summary),
    ]
    assert forms[0].collect() == forms[1].collect() == forms[2].collect()
    assert forms[2].schema.simpleString() == timeuse.TIME_USE_ROW.simpleString()


def test_typed_rows_need_every_column(survey):
    with pytest.raises(ValueError, match="other"):
        timeuse.as_time_use_rows(timeuse.summarize_survey(survey).drop("other"))


def test_filter_and_columns_reach_the_scan(spark, survey, tmp_path, plan_of):
    survey.withColumn("unused", F.lit("x")).write.parquet(str(tmp_path / "survey"))
    stored = spark.read.parquet(str(tmp_path / "survey"))
    plan = plan_of(timeuse.time_use_by_life_period(stored))
    assert "LessThanOrEqual(telfs,4)" in plan
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "unused" not in read and "t010101" in read


def write_csv(path):
    path.write_text('tucaseid,teage,telfs,t010101\n"20030100013280",60,2,870\n"20030100013344",41,1,620\n')
    return str(path)


def test_csv_survey(spark, tmp_path):
    path = write_csv(tmp_path / "survey.csv")
    names, df = read_survey(spark, path)
    assert names == ["tucaseid", "teage", "telfs", "t010101"]
    assert [t for _, t in df.dtypes] == ["string", "double", "double", "double"]
    assert df.agg(F.sum("t010101")).first()[0] == 1490
    _, inferred = read_survey(spark, path, infer=True)
    assert [t for _, t in inferred.dtypes] == ["bigint", "int", "int", "int"]


def test_rows_from_lines(spark):
    lines = spark.createDataFrame([("a,1,2.5",), ("b,x,1",)], "value STRING")
    names = ["id", "n", "m"]
    loose = [tuple(r) for r in survey_rows(lines, names, mode="permissive").collect()]
    assert loose == [("a", 1.0, 2.5), ("b", None, 1.0)]
    with pytest.raises(PySparkException, match="bad survey row: b,x,1"):
        survey_rows(lines, names).collect()
