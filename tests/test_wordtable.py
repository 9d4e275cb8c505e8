import datetime

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import wordfreq
from tallyworks.sinks.wordtable import WordTable

DAY = datetime.date(2024, 1, 31)
NEXT = datetime.date(2024, 2, 1)


@pytest.fixture
def table(spark, tmp_path):
    return WordTable(spark, str(tmp_path / "words"))


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "word STRING, date DATE, n LONG")


def state(table, month=None):
    return {(r["word"], r["date"]): r["n"] for r in table.counts(month).collect()}


def test_empty_table(table):
    assert state(table) == {} and table.months() == []


def test_batches_add_up_and_replays_do_not(spark, table):
    table.add_batch(batch(spark, ("a", DAY, 2), ("b", NEXT, 1)), "q", 0)
    table.add_batch(batch(spark, ("a", DAY, 3)), "q", 1)
    table.add_batch(batch(spark, ("a", DAY, 3)), "q", 1)
    assert state(table) == {("a", DAY): 5, ("b", NEXT): 1}
    assert state(table, "202402") == {("b", NEXT): 1}
    assert table.months() == ["202401", "202402"]


def test_queries_have_batches_of_their_own(spark, table):
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 0)
    table.add_batch(batch(spark, ("a", DAY, 1)), "p", 0)
    assert state(table) == {("a", DAY): 2}


def test_replay_that_moves_to_another_month(spark, table):
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 0)
    table.add_batch(batch(spark, ("a", NEXT, 1)), "q", 0)
    assert state(table) == {("a", NEXT): 1}


def test_compaction_changes_nothing_for_readers(spark, table):
    for number in range(4):
        table.add_batch(batch(spark, ("a", DAY, 1), (f"w{number}", NEXT, 1)), "q", number)
    table.add_batch(batch(spark, ("a", DAY, 10)), "p", 0)
    before = state(table)
    assert table.compact("202401") == 1
    assert state(table) == before
    assert table.compact("202401") == 2
    assert table.compact("202402") == 1
    assert state(table) == before
    # the newest batch may be replayed also after compaction
    table.add_batch(batch(spark, ("a", NEXT, 5)), "q", 3)
    changed = {**before, ("a", DAY): before["a", DAY] - 1, ("a", NEXT): 5}
    del changed["w3", NEXT]
    assert state(table) == changed
    table.add_batch(batch(spark, ("a", DAY, 100)), "q", 4)
    table.compact("202401")
    assert state(table)["a", DAY] == before["a", DAY] - 1 + 100


def test_folded_deltas_are_removed(spark, table, tmp_path):
    for number in range(5):
        table.add_batch(batch(spark, ("a", DAY, 1), ("b", NEXT, 1)), "q", number)
    table.add_batch(batch(spark, ("a", DAY, 1)), "p", 0)
    before = state(table)
    assert table.remove_folded() == 0
    table.compact("202401")
    assert table.remove_folded() == 0, "February is still open"
    table.compact_all()
    assert state(table) == before
    left = sorted(p.name for p in (tmp_path / "words/deltas/query=q").iterdir())
    assert left == ["batch=4"]
    table.add_batch(batch(spark, ("a", DAY, 1), ("b", NEXT, 1)), "q", 4)
    assert state(table) == before


def test_deltas_are_not_shuffled_by_query(spark, table, plan_of):
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 0)
    plan = table.counts()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(query" not in plan


def test_unfinished_compaction_is_not_seen(spark, table, tmp_path):
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 0)
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 1)
    table.compact("202401")
    spark.createDataFrame([("a", DAY, 99)], "word STRING, date DATE, n LONG").write.parquet(
        str(tmp_path / "words/bases/month=202401/version=2")
    )
    assert state(table) == {("a", DAY): 2}
    assert table.compact("202401") == 2
    assert state(table) == {("a", DAY): 2}


def test_compaction_reads_no_other_month(spark, table):
    for number in range(3):
        table.add_batch(batch(spark, ("a", DAY, 1), ("b", NEXT, 1)), "q", number)
    folded = table.to_fold(table.manifest(), "202401", {"q": 1})
    assert len(folded.inputFiles()) == 2 and all("month=202401" in f for f in folded.inputFiles())
    assert "FileScan" in folded._jdf.queryExecution().executedPlan().toString()
    table.compact("202401")
    read = table.counts("202401").inputFiles()
    assert sorted(f.split("/words/")[1].rsplit("/", 1)[0] for f in read) == [
        "bases/month=202401/version=1",
        "deltas/query=q/batch=2/month=202401",
    ]


def test_a_reader_keeps_its_snapshot(spark, table):
    for number in range(3):
        table.add_batch(batch(spark, ("a", DAY, 1)), "q", number)
    before = table.counts()
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 3)
    table.compact("202401")
    assert before.first()["n"] == 3 and table.counts().first()["n"] == 4


def test_log_holds_one_entry_a_compaction_and_old_ones_go(spark, table, tmp_path):
    table.add_batch(batch(spark, ("a", DAY, 1)), "q", 0)
    for number in range(1, 6):
        table.add_batch(batch(spark, ("a", DAY, 1)), "q", number)
        table.compact("202401")
    log = lambda: sorted(p.name for p in (tmp_path / "words/log").iterdir() if not p.name.startswith("."))
    assert len(log()) == 5 and table.manifest().folded == {"202401": {"q": 4}}
    removed = table.remove_folded()
    assert removed == 5 + 4 and len(log()) == 3, "five deltas, four bases"
    assert state(table) == {("a", DAY): 6}
    assert [p.name for p in (tmp_path / "words/bases/month=202401").iterdir()] == ["version=5"]


def test_of_two_compactions_at_a_time_one_fails(spark, table, monkeypatch):
    for number in range(2):
        table.add_batch(batch(spark, ("a", DAY, 1)), "q", number)
    stale = table.manifest()
    table.compact("202401")
    with monkeypatch.context() as patch:
        patch.setattr(table, "manifest", lambda: stale)
        with pytest.raises(RuntimeError, match="faster"):
            table.compact("202401")
    assert state(table) == {("a", DAY): 2}


def test_failed_write_fails_the_batch(spark, table):
    with pytest.raises(Exception):
        table.add_batch(batch(spark, ("a", DAY, 1)).withColumn("n", F.raise_error(F.lit("no"))), "q", 0)


RECORDS = [(1, "red blue red"), (2, ""), (3, "blue  green "), (4, "x")]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(RECORDS, "id INT, text STRING")


@pytest.fixture
def words(spark):
    return spark.createDataFrame([("red",), ("blue",), ("never",)], "word STRING")


def test_each_word_counts_once_per_record(records, words):
    tokens = wordfreq.space_tokens(F.col("text"))
    hits = wordfreq.dictionary_hits(records, words, "id", tokens=tokens)
    assert sorted(tuple(r) for r in hits.collect()) == [(1, "blue"), (1, "red"), (3, "blue")]
    counts = wordfreq.dictionary_counts(records, words, tokens=tokens)
    assert dict(counts.collect()) == {"red": 1, "blue": 2}
    per_id = wordfreq.dictionary_counts(records, words, "id", tokens=tokens)
    assert sorted(tuple(r) for r in per_id.collect()) == [(1, "blue", 1), (1, "red", 1), (3, "blue", 1)]


def test_words_are_counted_before_the_join(records, words, plan_of):
    counts = wordfreq.dictionary_counts(records, words, tokens=wordfreq.space_tokens(F.col("text")))
    plan = plan_of(counts)
    assert plan.index("Join") < plan.index("HashAggregate")


def test_frequent_word_is_split_in_the_join(spark, tmp_path, with_settings):
    path = str(tmp_path / "records")
    spark.range(60_000).select(
        "id", F.concat(F.lit("the w"), (F.col("id") % 5000).cast("string")).alias("text")
    ).write.parquet(path)
    spark.range(5000).select(
        F.when(F.col("id") == 0, "the").otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("word")
    ).write.parquet(str(tmp_path / "words"))
    with_settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    words = spark.read.parquet(str(tmp_path / "words"))
    hits = wordfreq.dictionary_hits(
        spark.read.parquet(path), words, "id", tokens=wordfreq.space_tokens(F.col("text"))
    )
    assert len(hits.collect()) == 60_000 + 60_000 - 12
    assert "skew=true" in hits._jdf.queryExecution().executedPlan().toString()


def test_small_dictionary_is_broadcast_without_a_shuffle(spark, records, words, tmp_path):
    words.write.parquet(str(tmp_path / "few"))
    stored = spark.read.parquet(str(tmp_path / "few"))
    hits = wordfreq.dictionary_hits(records, stored, "id", tokens=wordfreq.space_tokens(F.col("text")))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "RoundRobin" not in plan


@pytest.mark.parametrize(
    "reply, expected",
    [
        ('{"ret": 0, "msg": "ok", "terms": "a b a "}', ["a", "b"]),
        ('{"ret": 1, "msg": "down", "terms": "a b"}', []),
        ('{"ret": 0, "terms": "a"}', []),
        ("not json", []),
        (None, []),
    ],
)
def test_replies(spark, reply, expected):
    df = spark.createDataFrame([(reply,)], "r STRING")
    assert df.select(wordfreq.reply_tokens(F.col("r"))).first()[0] == expected
