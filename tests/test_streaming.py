import datetime
import itertools
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyworks.operators import clicks as batch_clicks
from tallyworks.operators import wordfreq
from tallyworks.operators.panes import single_windows
from tallyworks.plans import tables
from tallyworks.sinks.wordtable import WordTable
from tallyworks.sources.dictionary import RenewingDictionary
from tallyworks.sources.topics import stream_record_files
from tallyworks.streaming import clicks, recovery, runtime
from tallyworks.streaming.wordfreq import start_word_frequency

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture
def records(spark):
    """Events as click messages in the shape of a topic."""
    messages = batch_clicks.encode_clicks(tables.clicks(spark, SF), "event_id", "ts")
    return messages.select(
        "key", "value", F.lit("clicks").alias("topic"),
        (F.col("key").cast("int") % 3).alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )


class Topic:
    """A growing folder of record files with increasing times."""

    def __init__(self, spark, path):
        self._spark, self.path, self._numbers = spark, str(path), itertools.count(1)

    def add(self, rows):
        number = next(self._numbers)
        staged = f"{self.path}-staged-{number}"
        rows.coalesce(1).write.parquet(staged)
        os.makedirs(self.path, exist_ok=True)
        [part] = [f for f in os.listdir(staged) if f.endswith(".parquet")]
        target = os.path.join(self.path, f"{number:05d}.parquet")
        os.link(os.path.join(staged, part), target)
        os.utime(target, (1_700_000_000 + 10 * number,) * 2)

    def stream(self, files=1):
        return stream_record_files(self._spark, self.path, files)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def thirds(records):
    ordered = records.orderBy("offset")
    bounds = [(0, 333), (333, 666), (666, 10**9)]
    return [ordered.where((F.col("offset") >= a) & (F.col("offset") < b)) for a, b in bounds]


def sets_of(df):
    return {r["user_id"]: r["items"] for r in df.collect()}


def test_all_time_sets_equal_the_batch_and_survive_a_restart(spark, topic, thirds, records, tmp_path):
    path, checkpoint = str(tmp_path / "pairs"), str(tmp_path / "cp")

    def run():
        stream = batch_clicks.parse_clicks(topic.stream())
        runtime.finish(clicks.start_user_items(stream, path, checkpoint, every=None))

    topic.add(thirds[0])
    topic.add(thirds[1])
    run()
    first = spark.read.parquet(path)
    assert first.count() == first.distinct().count()
    topic.add(thirds[2])
    topic.add(thirds[0])
    run()
    run()
    pairs = spark.read.parquet(path)
    assert pairs.count() == pairs.distinct().count()
    expected = batch_clicks.user_item_sets(batch_clicks.parse_clicks(records))
    assert sets_of(clicks.read_user_item_sets(spark, path)) == sets_of(expected)


def test_all_sets_in_each_batch(spark, topic, thirds, records, tmp_path):
    for part in thirds:
        topic.add(part)
    seen = []

    def keep(batch, number):
        seen.append(sets_of(batch))

    stream = clicks.all_user_item_sets(batch_clicks.parse_clicks(topic.stream()))
    runtime.finish(
        runtime.start_batches(stream, keep, str(tmp_path / "cp"), every=None, output_mode="complete")
    )
    assert len(seen) == 3
    assert seen[-1] == sets_of(batch_clicks.user_item_sets(batch_clicks.parse_clicks(records)))
    for before, after in zip(seen, seen[1:]):
        assert all(set(items) <= set(after[user]) for user, items in before.items())


def test_closed_windows_equal_the_batch(spark, topic, thirds, records, tmp_path):
    out, history = str(tmp_path / "panes"), batch_clicks.parse_clicks(records)
    for part in thirds:
        topic.add(part)
    stream = batch_clicks.parse_clicks(topic.stream())
    runtime.finish(clicks.start_item_panes(stream, out, str(tmp_path / "cp"), "10 minutes", "6 hours", every=None))
    assert spark.read.parquet(out).agg(F.sum(F.size("clicks"))).first()[0] <= history.count()
    got = {
        (r["user_id"], r["window_start"]): r["clicks"]
        for r in single_windows(clicks.read_item_runs(spark, out, "1 day", "6 hours"), "6 hours").collect()
    }
    last = history.agg(F.max("ts")).first()[0]
    expected = {
        (r["user_id"], r["window_start"]): r["clicks"]
        for r in batch_clicks.user_item_windows(history, "1 day", "6 hours").collect()
    }

    def closed(windows):
        end = last - datetime.timedelta(minutes=10) - datetime.timedelta(days=1)
        return {k: v for k, v in windows.items() if k[1] <= end}

    assert closed(got) == closed(expected) and len(closed(expected)) > 1000


def test_panes_leave_the_state_and_keep_each_click_once(spark, topic, thirds, tmp_path):
    out, checkpoint = str(tmp_path / "panes"), str(tmp_path / "cp")
    for part in [*thirds[:2], thirds[1]]:  # the last batch comes once more
        topic.add(part)
    stream = batch_clicks.parse_clicks(topic.stream())
    query = clicks.start_item_panes(stream, out, checkpoint, "10 minutes", every=None)
    runtime.finish(query)
    assert runtime.STATE_STORE_SETTING and spark.conf.get(runtime.STATE_STORE_SETTING) != runtime.ROCKSDB_STORE
    held = query.lastProgress["stateOperators"][0]
    assert held["numRowsTotal"] < 10 and "rocksdb" in str(held["customMetrics"]).lower()
    kept = spark.read.parquet(out).select(F.explode("clicks")).count()
    assert kept <= 666 and kept + held["numRowsTotal"] >= 660


def click_rows(spark, *rows):
    start = datetime.datetime(2024, 1, 1)
    made = [(u, start + datetime.timedelta(minutes=m), i) for u, m, i in rows]
    return spark.createDataFrame(made, "user_id STRING, ts TIMESTAMP, item INT")


def test_a_pair_expires_and_comes_back(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "visits", "cp"))
    batches = [
        [("a", 0, 1), ("a", 5, 1), ("a", 5, 2), ("b", 40, 1)],
        [("a", 60, 1), ("a", 69, 1), ("b", 45, 1), ("z", 200, 9)],
    ]
    first = None
    for rows in batches:
        click_rows(spark, *rows).write.mode("append").parquet(source)
        stream = spark.readStream.schema("user_id STRING, ts TIMESTAMP, item INT").parquet(source)
        runtime.finish(clicks.start_item_visits(stream, out, checkpoint, "10 minutes", "1 minute", every=None))
        first = first or spark.read.parquet(out).collect()
    start = datetime.datetime(2024, 1, 1)
    minutes = lambda t: (t - start).seconds // 60
    seen = lambda rows: sorted((r["user_id"], r["item"], minutes(r["first_seen"]), minutes(r["expires"]), r["n"]) for r in rows)
    assert seen(first) == [("a", 1, 0, 15, 2), ("a", 2, 5, 15, 1)]
    visits = spark.read.parquet(out)
    assert seen(visits.collect()) == [("a", 1, 0, 15, 2), ("a", 1, 60, 79, 2), ("a", 2, 5, 15, 1), ("b", 1, 40, 55, 2)]
    at = lambda m: {r["user_id"]: r["items"] for r in clicks.living_items(visits, start + datetime.timedelta(minutes=m)).collect()}
    assert at(14) == {"a": [1, 2]} and at(15) == {} and at(50) == {"b": [1]} and at(70) == {"a": [1]}


def test_a_batch_is_replayed_under_its_number(spark, topic, thirds, tmp_path):
    topic.add(thirds[0])
    topic.add(thirds[1])
    seen, fault = [], recovery.interrupted_after(1, times=2)

    def start():
        return runtime.start_batches(
            topic.stream(), lambda b, n: seen.append((n, b.count())), str(tmp_path / "cp"), every=None, wrap=fault
        )

    assert recovery.run_through(start) == 2
    assert seen == [(0, 333), (1, 333), (1, 333), (1, 333)]
    topic.add(thirds[2])
    with pytest.raises(StreamingQueryException):
        recovery.run_through(lambda: runtime.start_batches(topic.stream(), lambda b, n: 1 / 0, str(tmp_path / "cp"), every=None), restarts=1)


def test_ledger_shows_holes(spark):
    rows = [(0, 0, 0, 5, 5), (1, 0, 5, 9, 4), (2, 0, 10, 12, 2), (0, 1, 3, 9, 5), (1, 1, 9, 10, 1)]
    report = spark.createDataFrame(rows, "batch INT, partition INT, from_offset LONG, until_offset LONG, n LONG")
    ledger = clicks.offset_ledger(report.withColumn("topic", F.lit("t"))).collect()
    assert {(r["batch"], r["partition"]) for r in ledger if not r["follows"]} == {(2, 0), (0, 1)}


def test_windows_read_from_the_click_table(spark, topic, thirds, records, tmp_path, plan_of):
    for part in [*thirds, thirds[1]]:
        topic.add(part)
    path = str(tmp_path / "clicks")
    stream = batch_clicks.parse_clicks(topic.stream())
    runtime.finish(clicks.start_click_table(stream, path, str(tmp_path / "cp"), every=None))
    end = datetime.datetime(2024, 1, 20, 6)
    start = end - datetime.timedelta(days=1)
    stored = clicks.read_click_table(spark, path, start, end)
    partition_filters = [
        line for line in plan_of(stored).splitlines() if line.startswith("PartitionFilters")
    ]
    assert "20240119" in partition_filters[0] and "20240120" in partition_filters[0]
    got = batch_clicks.user_item_window_at(stored, end, "1 DAY")
    expected = batch_clicks.user_item_window_at(batch_clicks.parse_clicks(records), end, "1 DAY")
    assert sorted(got.collect()) == sorted(expected.collect()) and expected.count() > 3


def test_offsets_are_reported_once_per_batch(spark, topic, thirds, tmp_path):
    topic.add(thirds[0])
    path, checkpoint = str(tmp_path / "offsets"), str(tmp_path / "cp")
    runtime.finish(clicks.start_offset_report(topic.stream(), path, checkpoint, every=None))
    topic.add(thirds[1])
    runtime.finish(clicks.start_offset_report(topic.stream(), path, checkpoint, every=None))
    report = clicks.read_offset_report(spark, path)
    assert sorted(r["batch"] for r in report.select("batch").distinct().collect()) == [0, 1]
    assert report.agg(F.sum("n")).first()[0] == 666
    expected = batch_clicks.offset_ranges(thirds[1]).collect()
    got = report.where("batch = 1").drop("batch").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_empty_batches_are_skipped(spark, topic, thirds, tmp_path):
    topic.add(thirds[0].limit(0))
    topic.add(thirds[0])
    numbers = []
    runtime.finish(
        runtime.start_batches(topic.stream(), lambda b, n: numbers.append(n), str(tmp_path / "cp"), every=None)
    )
    assert len(numbers) == 1


def start_words(spark, topic, table, checkpoint, words, **options):
    return start_word_frequency(
        topic.stream(), words, table, "items", checkpoint,
        date=F.to_date("timestamp"), every=None,
        tokenizer=lambda value: F.split(value, "\t"), **options,
    )


def test_word_frequency_through_failure_and_restart(spark, topic, thirds, records, tmp_path):
    table, checkpoint = WordTable(spark, str(tmp_path / "words")), str(tmp_path / "cp")
    numbers = spark.range(100).select(F.col("id").cast("string").alias("word"))
    words = RenewingDictionary(lambda: numbers)
    for part in thirds:
        topic.add(part)

    class Failing(WordTable):
        def add_batch(self, counts, query, batch):
            super().add_batch(counts, query, batch)
            if batch == 1:
                raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        runtime.finish(start_words(spark, topic, Failing(spark, str(tmp_path / "words")), checkpoint, words))
    runtime.finish(start_words(spark, topic, table, checkpoint, words, input_partitions=3))
    expected = wordfreq.dictionary_counts(
        records, numbers, F.to_date("timestamp").alias("date"), tokens=F.split("value", "\t")
    )
    rows = {(r["word"], r["date"]): r["n"] for r in table.counts().collect()}
    assert rows == {(r["word"], r["date"]): r["n"] for r in expected.collect()} and len(rows) > 500


def test_dictionary_changes_between_batches(spark, topic, thirds, tmp_path):
    for part in thirds:
        topic.add(part)
    ticks = itertools.count(0, 400)
    loads = itertools.count()
    words = RenewingDictionary(
        lambda: spark.createDataFrame([("7" if next(loads) == 0 else "8",)], "word STRING"),
        clock=lambda: next(ticks),
    )
    table = WordTable(spark, str(tmp_path / "words"))
    runtime.finish(start_words(spark, topic, table, str(tmp_path / "cp"), words))
    totals = dict(table.counts().groupBy("word").agg(F.sum("n")).collect())

    def mentions(parts, word):
        return sum(p.where(F.array_contains(F.split("value", "\t"), word)).count() for p in parts)

    assert totals == {"7": mentions(thirds[:1], "7"), "8": mentions(thirds[1:], "8")}


def test_console_sink(spark, topic, thirds, tmp_path):
    topic.add(thirds[0])
    query = runtime.start_console(topic.stream(), str(tmp_path / "cp"), every=None)
    runtime.finish(query)
    assert query.exception() is None


def test_interval_trigger(spark, topic, thirds, tmp_path):
    topic.add(thirds[0])
    query = runtime.start_table(
        topic.stream().select("key"), str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 333
