import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyworks.functions import text, times


@pytest.mark.parametrize(
    "value, pieces",
    [
        ("", [""]),
        (" ", []),
        ("   ", []),
        ("a b", ["a", "b"]),
        (" a  b  ", ["", "a", "", "b"]),
        ("a\tb ", ["a\tb"]),
    ],
)
def test_split_drops_only_trailing_empty_pieces(spark, value, pieces):
    df = spark.createDataFrame([(value,)], "v STRING")
    assert df.select(text.jvm_split(F.col("v"))).first()[0] == pieces


def test_split_with_other_separators(spark):
    df = spark.createDataFrame([("a|b||", "x,y,")], "v STRING, w STRING")
    row = df.select(text.jvm_split(F.col("v"), "|"), text.jvm_split(F.col("w"), ",")).first()
    assert (row[0], row[1]) == (["a", "b"], ["x", "y"])
    with pytest.raises(ValueError):
        text.jvm_split(F.col("v"), "ab")


@pytest.mark.parametrize(
    "value, term, expected",
    [
        ("Java Jakarta", "Java", True),
        ("JavaScript", "Java", False),
        ("I like java", "Java", False),
        ("ends in Java", "Java", True),
        ("Java, again", "Java", False),
        ("C++ and C#", "C++", True),
        ("a  b", "", True),
        ("a b ", "", False),
        ("New York", "New York", False),
        ("line\nJava", "Java", False),
    ],
)
def test_mentions_whole_tokens_only(spark, value, term, expected):
    df = spark.createDataFrame([(value,)], "v STRING")
    row = df.select(
        text.mentions(F.col("v"), term), text.mentioned_terms(F.col("v"), [term, "zzz"])
    ).first()
    assert row[0] is expected
    assert row[1] == ([term] if expected else [])


def test_unsound_records_fail_whatever_is_selected(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "y")], "v STRING, other STRING")
    checked = df.where(text.all_sound(F.col("v").try_cast("int").isNotNull(), F.col("v"), "number"))
    for action in (checked.select("other").collect, checked.count):
        with pytest.raises(PySparkException, match="bad number: bad"):
            action()
    with pytest.raises(ValueError):
        text.check_mode("lenient")


def test_epoch_formats(spark):
    df = spark.createDataFrame([("1574953308", 1574953308844)], "s STRING, ms LONG")
    row = df.select(
        times.format_epoch_seconds(F.col("s"), times.MONTH_FORMAT),
        times.format_epoch_millis(F.col("ms"), times.DAY_FORMAT),
    ).first()
    assert (row[0], row[1]) == ("201911", "2019-11-28")
