"""Records that must not pass, get lost or change places without an error."""

from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyworks.operators import articles, clicks, qa, wordfreq
from tallyworks.sinks.wordtable import WordTable
from tallyworks.sources import dictionary, files
from tallyworks.streaming import clicks as click_streams


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def strict_cases(spark):
    posting = qa.parse_postings(lines_of(spark, "1,7,,,5,Java", "1,8,,,oops,Java"))
    click = clicks.parse_clicks(lines_of(spark, "1574953308844\tu\t1", "soon\tu\t2"))
    article = articles.parse_articles(lines_of(spark, "no marker in here"))
    row = files.survey_rows(lines_of(spark, "a,1,2", "b,x,2"), ["id", "one", "two"])
    scored = spark.createDataFrame([(1, "Fortran 66", 3)], "qid LONG, tag STRING, high_score INT")
    vectors = qa.feature_vectors(scored, ["Java"], strict=True)
    return [(posting, "id"), (click, "user_id"), (article, "text"), (row, "two"), (vectors, "hs")]


@pytest.mark.parametrize("case", range(5))
def test_strict_mode_checks_what_nobody_selects(spark, case):
    df, column = strict_cases(spark)[case]
    for action in (df.select(column).collect, df.count):
        with pytest.raises(PySparkException, match="bad "):
            action()


def test_click_table_in_another_zone(spark, tmp_path, with_settings):
    stamps = spark.range(48).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("ts"),
        F.lit("u").alias("user_id"), F.col("id").cast("int").alias("item"),
    )
    (tmp_path / "in").mkdir()
    stamps.write.mode("overwrite").parquet(str(tmp_path / "in"))
    with_settings(spark__sql__session__timeZone="UTC")
    stream = spark.readStream.schema(stamps.schema).parquet(str(tmp_path / "in"))
    query = click_streams.start_click_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), every=None)
    query.processAllAvailable()
    query.stop()
    start, end = (datetime.fromtimestamp(1_700_000_000 + 3600 * h, timezone.utc) for h in (5, 32))
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        with_settings(spark__sql__session__timeZone=zone)
        assert click_streams.read_click_table(spark, str(tmp_path / "out"), start, end).count() == 27


def test_no_window_without_clicks(spark):
    empty = spark.createDataFrame([], "ts TIMESTAMP, user_id STRING, item INT")
    assert clicks.newest_window_end(empty) is None
    assert clicks.user_item_window_at(empty, None).collect() == []


@pytest.mark.parametrize(
    "reply, expected",
    [
        ('{"ret": 0, "msg": "ok", "terms": "a b a"}', ["a", "b"]),
        ('{"ret": 0.0, "msg": "ok", "terms": "a"}', ["a"]),
        ('{"ret": 1, "msg": "ok", "terms": "a"}', []),
        ('{"ret": "0", "msg": "ok", "terms": "a"}', []),
        ('{"ret": 0, "msg": 1, "terms": "a"}', []),
        ('{"ret": 0, "msg": "ok", "terms": ["a", "b"]}', []),
        ('{"ret": 0, "msg": "ok", "terms": 7}', []),
        ('{"ret": 0, "msg": "ok", "terms": null}', []),
        ('{"ret": 0, "msg": "ok"}', []),
        ("[1]", []),
        ("not json", []),
        (None, []),
    ],
)
def test_only_texts_count_as_terms(spark, reply, expected):
    df = spark.createDataFrame([(reply,)], "reply STRING")
    assert df.select(wordfreq.reply_tokens(F.col("reply")).alias("w")).first()["w"] == expected


def test_survey_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,teage,telfs\nx,30,2\n")
    (tmp_path / "b.csv").write_text("id,telfs,teage\ny,2,30\n")
    with pytest.raises(Exception, match="CSV header does not conform|FAILED_READ_FILE"):
        files.read_survey(spark, str(tmp_path))[1].collect()


def test_folded_months_are_listed(spark, tmp_path):
    table = WordTable(spark, str(tmp_path / "words"))
    for batch, day in enumerate(["2024-01-05", "2024-02-05", "2024-02-06"]):
        counts = spark.createDataFrame([("a", 1)], "word STRING, n LONG").withColumn("date", F.lit(day).cast("date"))
        table.add_batch(counts, "q", batch)
    table.compact_all()
    assert table.months() == ["202401", "202402"]
    assert sum(r["n"] for r in table.counts().collect()) == 3


def test_pages_without_an_end_keep_their_text(spark):
    pages = spark.createDataFrame(
        [("<TITLE>T</TITLE><BODY class='x'>one\ntwo<footer>f</footer>",), ("<bodyguard>no</bodyguard>",), (None,)],
        "html STRING",
    )
    rows = [tuple(r) for r in articles.parse_pages(pages).collect()]
    assert rows == [("T", "one\ntwo<footer>f</footer>"), (None, None), (None, None)]


def test_dictionary_outlives_its_source(spark, tmp_path):
    path, now = str(tmp_path / "words"), [0.0]
    held = dictionary.RenewingDictionary(lambda: dictionary.read_dictionary(spark, path), 300, lambda: now[0])

    def words_at(time):
        now[0] = time
        return sorted(r["word"] for r in held.current().collect())

    spark.createDataFrame([("a",), ("b",)], "word STRING").write.parquet(path)
    assert words_at(0.0) == ["a", "b"]
    spark.createDataFrame([("c",)], "word STRING").write.mode("overwrite").parquet(path)
    assert words_at(200.0) == ["a", "b"]
    assert words_at(400.0) == ["c"] and words_at(800.0) == ["c"] and words_at(1200.0) == ["c"]
    (tmp_path / "words").rename(tmp_path / "gone")
    assert words_at(1600.0) == ["c"]
    stored = [held.current().inputFiles()[0]]
    held.close()
    with pytest.raises(PySparkException):
        spark.read.parquet(*stored)
