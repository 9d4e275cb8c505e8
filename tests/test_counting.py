import pytest

from tallyworks.operators import counting
from tallyworks.sinks.files import preview, save_as_text
from tallyworks.sources.files import from_rows, read_lines, stream_lines

INCOME = [
    ("north", 10.5), ("south", 40.0), ("north", 20.25), ("east", 7.75),
    ("north", 30.0), ("south", 1.5), ("east", 2.5), ("north", 5.25),
]


@pytest.fixture
def income(spark):
    return from_rows(spark, INCOME, "company STRING, income DOUBLE")


def test_word_count_of_a_text_file(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("red fish blue fish\nred boat\n")
    counts = counting.word_count(read_lines(spark, str(tmp_path)))
    assert dict(counts.collect()) == {"red": 2, "fish": 2, "blue": 1, "boat": 1}


def test_blank_lines_count_as_an_empty_word(spark):
    lines = counting.lines_of(spark.createDataFrame([("a \n\n  \nb",)], "text STRING"), "text")
    assert dict(counting.word_count(lines).collect()) == {"a": 1, "": 1, "b": 1}


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_lines(spark, str(tmp_path / "absent"))


def test_totals_by_key(income):
    rows = {r["company"]: r for r in counting.totals_by_key(income, "company", "income").collect()}
    expected = {"north": (66.0, 4, 16.5), "south": (41.5, 2, 20.75), "east": (10.25, 2, 5.125)}
    assert rows.keys() == expected.keys()
    for company, (total, months, average) in expected.items():
        assert rows[company]["total"] == pytest.approx(total)
        assert rows[company]["months"] == months
        assert rows[company]["average"] == pytest.approx(average)


def test_both_forms_of_totals_agree(income):
    flat = counting.totals_by_key(income, "company", "income", 2)
    nested = counting.nested_totals_by_key(income, "company", "income", 2)
    assert sorted((r["company"], r["total"], r["average"]) for r in flat.collect()) == sorted(
        (r["company"], r["income"]["total"], r["income"]["average"]) for r in nested.collect()
    )


def test_totals_combine_before_the_shuffle(income, plan_of):
    plan = plan_of(counting.totals_by_key(income, "company", "income"))
    assert "partial_sum" in plan and "partial_count" in plan
    assert plan.count("Exchange (") <= 2


def test_single_text_file(spark, income, tmp_path):
    out = tmp_path / "out"
    save_as_text(counting.totals_by_key(income, "company", "income", 2), str(out), files=1)
    parts = list(out.glob("part-*"))
    assert len(parts) == 1
    assert "(north,66.0,4,16.5)" in parts[0].read_text().splitlines()


def test_text_output_keeps_its_partitions_by_default(spark, tmp_path):
    out = tmp_path / "out"
    save_as_text(spark.range(0, 100, 1, 4), str(out))
    assert len(list(out.glob("part-*"))) == 4


def test_preview(spark):
    assert preview(spark.range(100), 3).count() == 3


def test_streamed_lines(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("x y\n")
    (source / "b.txt").write_text("y\n")
    words = counting.words_of(stream_lines(spark, str(source), files_per_trigger=1))
    query = (
        words.groupBy("word").count().writeStream.outputMode("complete").format("memory")
        .queryName("streamed_words").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert dict(spark.table("streamed_words").collect()) == {"x": 1, "y": 2}
