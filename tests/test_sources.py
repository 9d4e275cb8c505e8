import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyworks.operators import timeuse
from tallyworks.sinks import jdbc
from tallyworks.sinks.topics import write_options
from tallyworks.sources import dictionary, topics
from tallyworks.sources.files import read_lines, read_table, spread, survey_rows
from tallyworks.session import CHECKPOINT_SETTING, materialize, new_folder, shared_folder


def test_topic_options():
    options = topics.topic_options(
        "h1:9091, h2:9092", ["a", "b"], group="g", start="smallest",
        max_offsets=topics.rate_cap(partitions=4), min_partitions=10,
    )
    assert options == {
        "kafka.bootstrap.servers": "h1:9091,h2:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "60",
        "minPartitions": "10",
    }


@pytest.mark.parametrize(
    "start, expected",
    [("latest", "latest"), ("largest", "latest"), ("earliest", "earliest"), ("Smallest", "earliest")],
)
def test_starting_offsets(start, expected):
    assert topics.starting_offsets(start) == expected


def test_explicit_offsets():
    assert json.loads(topics.starting_offsets({"t": {0: 5, 1: 7}})) == {"t": {"0": 5, "1": 7}}


def test_record_shapes(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"29"), bytearray(b"1\t29\t7"), "t", 0, 8252676, None)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP",
    )
    records = topics.text_records(raw)
    assert records.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert tuple(topics.record_tail(records).first()) == (8252676, "29", "1\t29\t7")


def test_topic_write_options():
    assert write_options("h:9092", "clicks") == {"kafka.bootstrap.servers": "h:9092", "topic": "clicks"}


def test_jdbc_dictionary_options():
    assert dictionary.jdbc_dictionary_options("jdbc:x", user="u", password="p") == {
        "url": "jdbc:x", "query": "SELECT DISTINCT word FROM user_words", "user": "u", "password": "p",
    }


def test_upsert_statements():
    create, ledger, upsert, record = jdbc.upsert_statements("staged", "201911", "words", 7)
    assert "CREATE TABLE IF NOT EXISTS word_count_201911" in create and "UNIQUE KEY word (word, date)" in create
    assert "batch_ledger" in ledger
    assert "FROM staged" in upsert and "count = count + VALUES(count)" in upsert and "batch = 7" in upsert
    assert record.endswith("VALUES ('words', '201911', 7)")


def test_dictionary_is_renewed_when_old(spark):
    clock, loads = [0.0], []

    def load():
        loads.append(clock[0])
        return spark.createDataFrame([(f"w{len(loads)}",)], "word STRING")

    words = dictionary.RenewingDictionary(load, max_age=300, clock=lambda: clock[0])
    seen = []
    for at in (0, 299, 300, 301, 602):
        clock[0] = at
        seen.append(words.current().first()["word"])
    assert seen == ["w1", "w1", "w1", "w2", "w3"]


def test_failed_load_keeps_the_last_words(spark):
    clock, broken = [0.0], [False]

    def load():
        if broken[0]:
            return spark.read.parquet("/no/such/table")
        return spark.createDataFrame([("kept",)], "word STRING")

    words = dictionary.RenewingDictionary(load, max_age=1, clock=lambda: clock[0])
    words.current()
    broken[0], clock[0] = True, 10.0
    assert words.current().first()["word"] == "kept"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dictionary.RenewingDictionary(load).current()


def test_stored_dictionary(spark, tmp_path):
    spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "word STRING").write.parquet(str(tmp_path / "words"))
    words = dictionary.read_dictionary(spark, str(tmp_path / "words"))
    assert sorted(r["word"] for r in words.collect()) == ["a", "b"]


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get(CHECKPOINT_SETTING)
    assert shared_folder(spark) == named
    assert new_folder(spark, "x").startswith(f"{named}/x-")
    stored = materialize(spark.range(5), "numbers")
    assert stored.count() == 5 and named in stored.inputFiles()[0]


def test_no_folder_on_a_cluster_without_the_setting(monkeypatch, spark):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Cluster:
        conf = Conf()
        sparkContext = Context()

    assert shared_folder(Cluster()) is None
    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        new_folder(Cluster(), "x")


def test_spread_only_deals_out_small_scans(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    small = read_table(spark, str(tmp_path), "one")
    assert spread(small).rdd.getNumPartitions() == 4
    wide = spark.range(0, 100, 1, 9)
    assert spread(wide) is wide


def test_dictionary_of_a_batch_stays_when_replayed(spark, tmp_path):
    versions = dictionary.DictionaryVersions(spark, str(tmp_path / "d"))
    with pytest.raises(ValueError, match="no dictionary"):
        versions.for_batch("q", 0)

    def publish(*words):
        return versions.publish(spark.createDataFrame([(w,) for w in words], "word STRING"))

    def words_of(batch, query="q"):
        return sorted(r["word"] for r in versions.for_batch(query, batch).collect())

    assert publish("a", "b", "a", None) == 1
    assert words_of(0) == ["a", "b"]
    assert publish("c") == 2
    assert words_of(0) == ["a", "b"] and words_of(1) == ["c"] and words_of(0, "p") == ["c"]
    assert versions.versions() == [1, 2]
    (tmp_path / "d/words/version=3").mkdir()  # begun, not finished
    assert words_of(2) == ["c"]


def test_survey_of_hundreds_of_columns(spark):
    names = ["case"] + [f"t01{i:04d}" for i in range(500)]
    lines = ["c1," + ",".join(str(i) for i in range(500)), "c2," + ",".join("1" for _ in range(499))]
    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    rows = {r["case"]: r for r in survey_rows(df, names, mode="permissive").collect()}
    assert list(rows["c1"])[1:] == [float(i) for i in range(500)]
    assert rows["c2"][499] == 1.0 and rows["c2"][500] is None
    total = timeuse.sum_columns([F.col(n) for n in names[1:]])
    assert survey_rows(df.limit(1), names).select(total).first()[0] == sum(range(500))
    with pytest.raises(PySparkException, match="bad survey row"):
        survey_rows(df, names).collect()


def test_lines_end_where_they_are_told_to(spark, tmp_path):
    (tmp_path / "t").write_bytes(b"a\rb\nc\n")
    values = lambda df: [r["value"] for r in df.collect()]
    assert values(read_lines(spark, str(tmp_path / "t"))) == ["a", "b", "c"]
    assert values(read_lines(spark, str(tmp_path / "t"), "\n")) == ["a\rb", "c"]
