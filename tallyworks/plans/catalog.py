"""The registered queries: each takes a session and a data folder and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.times import (
    DAY_FORMAT,
    MONTH_FORMAT,
    format_epoch_millis,
    format_epoch_seconds,
)
from tallyworks.operators import (
    articles,
    clicks,
    clustering,
    counting,
    qa,
    ranking,
    sampling,
    timeuse,
    wordfreq,
)
from tallyworks.operators.grouping import (
    SKETCH_RANK_ERROR,
    integer_median,
    merge_sketches,
    quantile_sketches,
    rank_errors,
    sketch_quantile,
    whole_lists,
)
from tallyworks.plans import tables
from tallyworks.session import materialize, new_folder
from tallyworks.sinks.files import save_as_text, save_survey
from tallyworks.sinks.wordtable import WordTable
from tallyworks.sources.dictionary import DictionaryVersions, RenewingDictionary
from tallyworks.sources.files import read_lines, read_survey, survey_rows
from tallyworks.sources.topics import record_tail
from tallyworks.streaming import clicks as click_streams
from tallyworks.streaming.recovery import interrupted_after, run_through
from tallyworks.streaming.runtime import finish
from tallyworks.streaming.wordfreq import start_word_frequency

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

# The day that batches without a time of their own are counted for.
BATCH_DAY = "2024-01-15"


def query(build: Query) -> Query:
    """Register ``build`` under its own name; the tables are always read as UTC."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables.use_utc(spark)
        return build(spark, folder)

    _QUERIES[build.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- words and income


@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return counting.word_count(tables.document_lines(spark, folder))


@query
def word_count_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """The lines written to text files and read back, then counted; the counts are written and read as text, too."""
    path = new_folder(spark, "lines")
    tables.document_lines(spark, folder).write.option("lineSep", "\n").text(path)
    counted = counting.word_count(read_lines(spark, path, line_separator="\n"), "value")
    totals = new_folder(spark, "counts")
    save_as_text(counted.select("n", F.hex("word").alias("word")), totals, files=1)
    fields = F.split(F.regexp_extract("value", r"^\((.*)\)$", 1), ",")
    return read_lines(spark, totals).select(
        F.unhex(F.get(fields, F.lit(1))).cast("string").alias("word"), F.get(fields, F.lit(0)).cast("long").alias("n")
    )


@query
def tokenize_lines(spark: SparkSession, folder: str) -> DataFrame:
    return counting.words_of(tables.document_lines(spark, folder, "doc_id"), "doc_id")


@query
def income_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return counting.totals_by_key(tables.income(spark, folder), "o_custkey", "o_totalprice", 2)


@query
def income_by_key_struct(spark: SparkSession, folder: str) -> DataFrame:
    nested = counting.nested_totals_by_key(
        tables.income(spark, folder), "o_custkey", "o_totalprice", 2
    )
    return nested.select("o_custkey", "income.total", "income.average")


# --- parsing and formatting


@query
def parse_clicks(spark: SparkSession, folder: str) -> DataFrame:
    parsed = clicks.parse_clicks(tables.click_messages(spark, folder), "event_id")
    return parsed.select("event_id", F.unix_millis("ts").alias("ts_ms"), "user_id", "item")


@query
def parse_postings(spark: SparkSession, folder: str) -> DataFrame:
    return qa.parse_postings(tables.posting_lines(spark, folder))


@query
def parse_articles(spark: SparkSession, folder: str) -> DataFrame:
    return articles.parse_articles(tables.article_lines(spark, folder), "doc_id")


@query
def parse_pages(spark: SparkSession, folder: str) -> DataFrame:
    return articles.parse_pages(tables.table(spark, folder, "pages"), "page_id")


@query
def encode_events(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.encode_clicks(tables.clicks(spark, folder), "event_id")


@query
def decode_segments(spark: SparkSession, folder: str) -> DataFrame:
    replies = tables.segment_replies(spark, folder)
    words = wordfreq.reply_tokens(F.col("reply"))
    return wordfreq.words_in_records(replies, "conv_id", "turn", tokens=words)


@query
def date_buckets(spark: SparkSession, folder: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    dated = tables.table(spark, folder, "events").select(
        format_epoch_millis(millis, MONTH_FORMAT).alias("month"),
        format_epoch_seconds(seconds, DAY_FORMAT).alias("day"),
    )
    return counting.count_by(dated, "month", "day")


# --- ranking


@query
def docs_mentioning_term(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.documents_mentioning(tables.documents(spark, folder), "the")


@query
def rank_terms(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_terms(tables.documents(spark, folder), tables.TERMS)


@query
def rank_terms_one_pass(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_terms_one_pass(tables.documents(spark, folder), tables.TERMS)


@query
def term_doc_index(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.term_index(tables.documents(spark, folder), tables.TERMS)


def _stored_index(spark: SparkSession, folder: str) -> DataFrame:
    index = ranking.term_index(tables.documents(spark, folder), tables.TERMS)
    return materialize(index, "term-index")


@query
def term_postings(spark: SparkSession, folder: str) -> DataFrame:
    lists = ranking.postings_by_term(_stored_index(spark, folder), width=tables.DOCUMENT_RANGE)
    return lists.select("term", "piece", F.array_join("doc_ids", ",").alias("doc_ids"))


@query
def rank_terms_from_index(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_from_index(_stored_index(spark, folder))


# --- time use


def _summary(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    survey = tables.survey(spark, folder)
    return timeuse.time_use_summary(survey, *timeuse.classify_columns(survey.columns), *keep)


@query
def life_period_labels(spark: SparkSession, folder: str) -> DataFrame:
    survey = timeuse.in_labour_force(tables.survey(spark, folder))
    return counting.count_by(
        survey.select(*timeuse.life_period_columns()), *timeuse.GROUP_COLUMNS
    )


@query
def time_use_summary(spark: SparkSession, folder: str) -> DataFrame:
    hours = [F.round(name, 6).alias(name) for name in timeuse.HOUR_COLUMNS]
    return _summary(spark, folder, "case_id").select("case_id", *timeuse.GROUP_COLUMNS, *hours)


@query
def time_use_grouped(spark: SparkSession, folder: str) -> DataFrame:
    return timeuse.time_use_grouped(_summary(spark, folder))


@query
def time_use_grouped_sql(spark: SparkSession, folder: str) -> DataFrame:
    return timeuse.time_use_grouped_sql(_summary(spark, folder))


@query
def time_use_grouped_typed(spark: SparkSession, folder: str) -> DataFrame:
    return timeuse.time_use_grouped_typed(_summary(spark, folder))


@query
def time_use_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The wide survey written as CSV files with a header and read back by it."""
    path = new_folder(spark, "survey")
    save_survey(tables.wide_survey(spark, folder), path, header=True)
    names, survey = read_survey(spark, path)
    summary = timeuse.time_use_summary(survey, *timeuse.classify_columns(names), "case_id")
    hours = [F.round(name, 6).alias(name) for name in timeuse.HOUR_COLUMNS]
    return summary.select("case_id", *timeuse.GROUP_COLUMNS, *hours)


@query
def time_use_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same from separated lines without a header, of which every tenth case has lost its last field: averages of the sound ones."""
    path, wide = new_folder(spark, "survey"), tables.wide_survey(spark, folder)
    save_survey(wide, path)
    cut = F.substring_index("value", ",", 1).cast("long") % 10 == 0
    shorter = F.regexp_replace("value", ",[^,]*$", "")
    lines = read_lines(spark, path).select(F.when(cut, shorter).otherwise(F.col("value")).alias("value"))
    survey = survey_rows(lines, wide.columns, mode="permissive")
    sound = survey.where(F.col(wide.columns[-1]).isNotNull())
    return timeuse.time_use_grouped(timeuse.time_use_summary(sound, *timeuse.classify_columns(wide.columns)))


# --- questions and answers


@query
def qa_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return qa.question_answer_pairs(tables.postings(spark, folder))


@query
def qa_grouped(spark: SparkSession, folder: str) -> DataFrame:
    return qa.answer_counts(tables.postings(spark, folder))


@query
def qa_answer_lists(spark: SparkSession, folder: str) -> DataFrame:
    """All answers of a question in one list."""
    pieces = qa.answers_by_question(tables.postings(spark, folder), tables.ANSWER_RANGE)
    lists = whole_lists(pieces, ["qid"], "answers")
    scores = F.transform("answers", lambda a: a["answer_score"].cast("string"))
    return lists.select(
        "qid", "piece", F.array_join(F.array_sort(scores), ",").alias("scores")
    )


@query
def best_answer_score(spark: SparkSession, folder: str) -> DataFrame:
    return qa.best_answer_scores(tables.postings(spark, folder))


@query
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    scored = qa.best_answer_scores(tables.postings(spark, folder))
    return qa.feature_vectors(scored, tables.VOCABULARY, tables.SPREAD)


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return qa.vectors_from_postings(
        tables.postings(spark, folder), tables.VOCABULARY, tables.SPREAD
    )


@query
def vectors_from_postings(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder)


@query
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_sample(_vectors(spark, folder), "lx", 3, "qid")


@query
def uniform_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.uniform_sample(_vectors(spark, folder), 15, "qid")


# --- clustering


@query
def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.assign_clusters(_vectors(spark, folder), tables.start_centers())


@query
def kmeans_step(spark: SparkSession, folder: str) -> DataFrame:
    points = clustering.weighted_points(_vectors(spark, folder))
    return clustering.cluster_means(points, tables.start_centers())


@query
def kmeans_fit(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    fit = clustering.fit_centers(vectors, tables.start_centers())
    return clustering.centers_frame(vectors, fit.centers)


@query
def group_median(spark: SparkSession, folder: str) -> DataFrame:
    return integer_median(_vectors(spark, folder), ["lx"], "hs")


@query
def group_median_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Median prices in cents out of monthly sketches that are merged, held against all rows, and the exact ones."""
    keys = ["l_returnflag", "l_linestatus"]
    prices = tables.table(spark, folder, "lineitem").select(
        *keys,
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.round(F.col("l_extendedprice") * 100).cast("int").alias("cents"),
    )
    monthly = quantile_sketches(prices, [*keys, "month"], "cents")
    answers = merge_sketches(monthly, keys).select(*keys, sketch_quantile(F.col("sketch")).alias("near"))
    checked = rank_errors(prices, answers, keys, "cents", "near")
    return checked.join(integer_median(prices, keys, "cents"), keys).select(
        *keys, "n", "median", (F.col("rank_error") <= SKETCH_RANK_ERROR).alias("within_bound")
    )


@query
def cluster_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = clustering.cluster_summary(
        _vectors(spark, folder), tables.start_centers(), tables.VOCABULARY, tables.SPREAD
    )
    return summary.withColumn("percent", F.round("percent", 6))


def _fitted_summary(spark: SparkSession, folder: str) -> DataFrame:
    vectors = materialize(_vectors(spark, folder), "vectors")  # sampled, then gathered to points
    start = sampling.sample_centers(vectors, 15, tables.VOCABULARY, tables.SPREAD)
    points = clustering.stored_points(vectors)
    fit = clustering.fit_centers(points, start)
    return clustering.cluster_summary(points, fit.centers, tables.VOCABULARY, tables.SPREAD)


@query
def posting_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """The whole chain: postings, vectors, sampled centers, k-means, summary."""
    return _fitted_summary(spark, folder).withColumn("percent", F.round("percent", 6))


@query
def cluster_report(spark: SparkSession, folder: str) -> DataFrame:
    summary = clustering.cluster_summary(
        _vectors(spark, folder), tables.start_centers(), tables.VOCABULARY, tables.SPREAD
    )
    return clustering.report_lines(summary)


# --- dictionary words


@query
def dictionary_words(spark: SparkSession, folder: str) -> DataFrame:
    return tables.dictionary(spark, folder)


@query
def dictionary_hits(spark: SparkSession, folder: str) -> DataFrame:
    return wordfreq.dictionary_hits(
        tables.documents(spark, folder),
        materialize(tables.dictionary(spark, folder), "dictionary"),
        "doc_id",
        tokens=wordfreq.space_tokens(F.col("text")),
    )


@query
def dictionary_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wordfreq.dictionary_counts(
        tables.documents(spark, folder),
        tables.dictionary(spark, folder),
        tokens=wordfreq.space_tokens(F.col("text")),
    )


@query
def word_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and conversation turns as two batches; the second one is replayed."""
    dictionary = RenewingDictionary(lambda: tables.dictionary(spark, folder))
    store = WordTable(spark, new_folder(spark, "word-table"))
    tokens = wordfreq.space_tokens(F.col("text"))
    day = F.lit(BATCH_DAY).cast("date").alias("date")
    documents = tables.documents(spark, folder)
    turns = tables.table(spark, folder, "conversations")
    for batch, records in ((0, documents), (1, turns), (1, turns)):
        counts = wordfreq.dictionary_counts(records, dictionary.current(), day, tokens=tokens)
        store.add_batch(counts, "words", batch)
    dictionary.close()
    return _as_text_days(store.counts())


@query
def word_table_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Events in batches, over two months; the table is compacted after the second and the fourth write."""
    store = WordTable(spark, new_folder(spark, "word-table"))

    def add(number: int) -> None:
        days = F.date_add(F.to_date("ts"), (F.col("user_id") % 2 * 31).cast("int"))
        events = tables.event_batch(spark, folder, number)
        counts = counting.count_by(events.select(F.col("event_type").alias("word"), days.alias("date")), "word", "date")
        store.add_batch(counts, "types", number)

    add(0)
    add(1)
    store.compact_all()
    add(2)
    add(2)
    store.compact("202401")
    return _as_text_days(store.counts())


def _as_text_days(counts: DataFrame) -> DataFrame:
    return counts.select("word", F.col("date").cast("string").alias("date"), "n")


# --- click state


@query
def offset_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.offset_ranges(tables.records(spark, folder))


@query
def record_log(spark: SparkSession, folder: str) -> DataFrame:
    return record_tail(tables.records(spark, folder))


def _set_text(sets: DataFrame) -> DataFrame:
    return sets.select(
        "user_id", "piece", F.array_join(F.col("items").cast("array<string>"), ",").alias("items")
    )


@query
def user_item_sets(spark: SparkSession, folder: str) -> DataFrame:
    """All items of a user in one set; a user without items has none."""
    sets = whole_lists(clicks.user_item_sets(tables.clicks(spark, folder), tables.ITEM_RANGE), ["user_id"], "items")
    return _set_text(sets).withColumn("items", F.nullif("items", F.lit("")))


def _window_text(windows: DataFrame) -> DataFrame:
    pair = F.transform(
        "clicks",
        lambda c: F.concat_ws(
            ":", F.unix_micros(c["ts"]).cast("string"), c["item"].cast("string")
        ),
    )
    return windows.withColumn("clicks", F.array_join(pair, ","))


@query
def user_item_windows(spark: SparkSession, folder: str) -> DataFrame:
    windows = clicks.user_item_windows(tables.clicks(spark, folder), "1 day", "6 hours", tables.ITEM_RANGE)
    return _window_text(windows).withColumn(
        "window_start", F.unix_seconds("window_start")
    )


def _run_text(runs: DataFrame) -> DataFrame:
    return _window_text(runs).withColumns(
        {name: F.unix_seconds(name) for name in ("first_start", "last_start")}
    )


@query
def user_item_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of an hour every 30 seconds."""
    return _run_text(clicks.user_item_runs(tables.clicks(spark, folder), width=tables.ITEM_RANGE))


@query
def user_item_window_at(spark: SparkSession, folder: str) -> DataFrame:
    """The newest day-long window."""
    history = tables.clicks(spark, folder)
    end = clicks.newest_window_end(history, "6 hours")
    return _window_text(clicks.user_item_window_at(history, end, "1 DAY", tables.ITEM_RANGE))


# --- the same through Structured Streaming


@query
def stream_user_item_sets(spark: SparkSession, folder: str) -> DataFrame:
    path, checkpoint = new_folder(spark, "user-items"), new_folder(spark, "checkpoint")
    finish(
        click_streams.start_user_items(
            tables.click_stream(spark, folder), path, checkpoint, every=None
        )
    )
    return _set_text(click_streams.read_user_item_sets(spark, path, tables.ITEM_RANGE))


@query
def stream_item_window_at(spark: SparkSession, folder: str) -> DataFrame:
    """The newest day-long window, all clicks of a user in one list."""
    path, checkpoint = new_folder(spark, "clicks"), new_folder(spark, "checkpoint")
    finish(
        click_streams.start_click_table(
            tables.click_stream(spark, folder), path, checkpoint, every=None
        )
    )
    end = clicks.newest_window_end(click_streams.read_click_table(spark, path), "6 hours")
    stored = click_streams.read_click_table(spark, path, end - timedelta(days=1), end)
    window = clicks.user_item_window_at(stored, end, "1 DAY", tables.ITEM_RANGE)
    return _window_text(whole_lists(window, ["user_id"], "clicks"))


@query
def stream_offset_ranges(spark: SparkSession, folder: str) -> DataFrame:
    path, checkpoint = new_folder(spark, "offsets"), new_folder(spark, "checkpoint")
    finish(
        click_streams.start_offset_report(
            tables.record_stream(spark, folder), path, checkpoint, every=None
        )
    )
    report = click_streams.read_offset_report(spark, path)
    return report.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"),
        F.max("until_offset").alias("until_offset"),
        F.sum("n").alias("n"),
    )


@query
def stream_word_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as words, counted per day of the event; the dictionary leaves out the first one by name."""
    types = tables.table(spark, folder, "events").select(F.col("event_type").alias("word"))
    known = types.where(F.col("word") > types.agg(F.min("word")).scalar())
    dictionary = RenewingDictionary(lambda: wordfreq.distinct_words(known))
    store = WordTable(spark, new_folder(spark, "word-table"))
    finish(
        start_word_frequency(
            tables.record_stream(spark, folder),
            dictionary,
            store,
            "event-types",
            new_folder(spark, "checkpoint"),
            date=F.to_date("timestamp"),
            every=None,
        )
    )
    dictionary.close()
    return _as_text_days(store.counts())


# --- streams of several batches


@query
def stream_item_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of an hour every 30 seconds, from the panes that three batches have closed."""
    arrivals = tables.Arrivals(spark, folder)
    path, checkpoint = new_folder(spark, "panes"), new_folder(spark, "checkpoint")
    for number in range(tables.BATCHES):
        arrivals.add(number)
        finish(
            click_streams.start_item_panes(
                arrivals.clicks(), path, checkpoint, "10 minutes", width=tables.ITEM_RANGE, every=None
            )
        )
    return _run_text(click_streams.read_item_runs(spark, path))


@query
def stream_item_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that live for two days without a click, over three batches: they expire and come back."""
    arrivals = tables.Arrivals(spark, folder)
    path, checkpoint = new_folder(spark, "visits"), new_folder(spark, "checkpoint")
    for number in range(tables.BATCHES):
        arrivals.add(number)
        finish(
            click_streams.start_item_visits(
                arrivals.clicks(), path, checkpoint, "2 days", "10 minutes", every=None
            )
        )
    times = {name: F.unix_micros(name) for name in ("first_seen", "last_seen", "expires")}
    return spark.read.parquet(path).withColumns(times)


@query
def stream_replayed_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger of offsets over three batches, of which the second fails after its output and is replayed."""
    arrivals = tables.Arrivals(spark, folder)
    path, checkpoint = new_folder(spark, "offsets"), new_folder(spark, "checkpoint")
    fault = interrupted_after(1)
    for number in range(tables.BATCHES):
        arrivals.add(number)
        run_through(
            lambda: click_streams.start_offset_report(
                arrivals.dense_records(), path, checkpoint, every=None, wrap=fault
            )
        )
    return click_streams.offset_ledger(click_streams.read_offset_report(spark, path))


@query
def stream_dictionary_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Event types counted against the dictionary of their batch.

    The first batch knows all types but the first by name, the second all but the last, the third the
    first alone. The second batch fails after its output, the third dictionary is
    published, and the replayed batch still counts against its own.
    """
    types = tables.table(spark, folder, "events").select(F.col("event_type").alias("word"))
    ends = types.agg(F.min("word").alias("first"), F.max("word").alias("last")).first()
    first, last = (F.col("word") == F.lit(ends[name]) for name in ("first", "last"))
    versions = DictionaryVersions(spark, new_folder(spark, "dictionaries"))
    store = WordTable(spark, new_folder(spark, "word-table"))
    arrivals, checkpoint = tables.Arrivals(spark, folder), new_folder(spark, "checkpoint")
    fault = interrupted_after(1)

    def start():
        return start_word_frequency(
            arrivals.records(),
            versions,
            store,
            "event-types",
            checkpoint,
            date=F.to_date("timestamp"),
            every=None,
            wrap=fault,
        )

    versions.publish(types.where(~first))
    arrivals.add(0)
    run_through(start)
    versions.publish(types.where(~last))
    arrivals.add(1)
    try:
        run_through(start, restarts=0)
    except StreamingQueryException:
        versions.publish(types.where(first))
    run_through(start)
    arrivals.add(2)
    run_through(start)
    return _as_text_days(store.counts())
