import pytest
from pyspark.errors import PySparkException

from tallyworks.operators.articles import parse_articles, parse_pages

LINE = "<page> <title>Scala</title><text>Scala is </text> fine</text> </page> "


def test_fixed_offsets(spark):
    df = spark.createDataFrame([(LINE,)], "value STRING")
    assert tuple(parse_articles(df).first()) == ("Scala", "Scala is </text> fine")


@pytest.mark.parametrize("line", ["no marker at all", "short</title><text>", "<page> <title>x</title><text>y"])
def test_unsound_lines(spark, line):
    df = spark.createDataFrame([(line,), (LINE,)], "value STRING")
    assert parse_articles(df, mode="permissive").count() == 1
    with pytest.raises(PySparkException, match="bad article"):
        parse_articles(df).collect()


def test_pages_by_tags(spark):
    rows = [
        (1, "<html><title>T</title><body>one</body> two</body></html>"),
        (2, "<html><body>only text</body></html>"),
        (3, "</title><title>late"),  # no end tag: up to the end of the page
    ]
    df = spark.createDataFrame(rows, "page_id LONG, html STRING")
    got = {r["page_id"]: (r["title"], r["text"]) for r in parse_pages(df, "page_id").collect()}
    assert got == {1: ("T", "one"), 2: (None, "only text"), 3: ("late", None)}
