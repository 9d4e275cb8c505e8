"""The operators' inputs, made from the test tables.

Times in the tables are without a zone; they are read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.counting import lines_of
from tallyworks.operators.timeuse import OTHER_PREFIXES, PRIMARY_PREFIXES, WORK_PREFIXES
from tallyworks.operators.wordfreq import distinct_words, space_tokens
from tallyworks.session import new_folder
from tallyworks.sources.files import read_table, spread, stream_table

# Terms that occur in the documents, and one that does not.
TERMS = ["the", "and", "of", "der", "und", "la", "de", "que", "est", "que.", "zzz"]

# Order priorities as tags.
VOCABULARY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SPREAD = 50_000

TOPIC = "events"

# Numbers of a range that make one piece of a collection: documents, items, answers.
DOCUMENT_RANGE, ITEM_RANGE, ANSWER_RANGE = 256, 16, 4

# Batches that the events come in, where a stream takes several.
BATCHES = 3


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def income(spark: SparkSession, folder: str) -> DataFrame:
    """Company and monthly income: customers and their orders."""
    return table(spark, folder, "orders").select("o_custkey", "o_totalprice")


def document_lines(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return lines_of(documents(spark, folder), "text", *keep)


def article_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as one article line of the fixed layout."""
    line = F.concat(
        F.lit("<page> <title>"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")),
        F.lit("</title><text>"),
        F.col("text"),
        F.lit("</text> </page> "),
    )
    return table(spark, folder, "documents").select("doc_id", line.alias("value"))


def _item() -> Column:
    return F.get_json_object("props", "$.k").cast("int").alias("item")


def _clicks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        _item(),
        "event_id",
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return _clicks(table(spark, folder, "events"))


def click_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _clicks(stream_table(spark, folder, "events"))


def click_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw click records, with their id."""
    return table(spark, folder, "events").select(
        "event_id",
        F.concat_ws(
            "\t",
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
            F.col("user_id").cast("string"),
            F.get_json_object("props", "$.k"),
        ).alias("value"),
    )


def _records(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("event_type").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_batch(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """One of ``BATCHES`` equal parts of the events, in the order of their ids and times."""
    events = table(spark, folder, "events")
    ids = events.agg(F.max("event_id") + 1).scalar()
    return events.where(F.call_function("div", F.col("event_id") * BATCHES, ids) == number)


class Arrivals:
    """A folder that a stream reads and that parts of the events arrive in, one after another."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        self.path = new_folder(spark, "arrivals")
        self.schema = table(spark, folder, "events").schema

    def add(self, number: int) -> None:
        event_batch(self._spark, self._folder, number).write.mode("append").parquet(self.path)

    def stream(self) -> DataFrame:
        return self._spark.readStream.schema(self.schema).parquet(self.path)

    def clicks(self) -> DataFrame:
        return _clicks(self.stream())

    def records(self) -> DataFrame:
        return _records(self.stream())

    def dense_records(self) -> DataFrame:
        """The same with three partitions by event, in which offsets have no holes."""
        return _records(self.stream()).withColumns(
            {
                "partition": (F.col("offset") % 3).cast("int"),
                "offset": F.call_function("div", F.col("offset"), F.lit(3).cast("long")),
            }
        )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the shape of topic records, three partitions by user."""
    return _records(table(spark, folder, "events"))


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _records(stream_table(spark, folder, "events"))


def posting_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as questions and line items as answers, in the comma-separated format."""
    asked = table(spark, folder, "orders").select(
        F.concat_ws(
            ",",
            F.lit("1"),
            F.col("o_orderkey").cast("string"),
            F.lit(""),
            F.lit(""),
            F.lit("0"),
            F.col("o_orderpriority"),
        ).alias("value")
    )
    given = table(spark, folder, "lineitem").select(
        F.concat_ws(
            ",",
            F.lit("2"),
            _answer_id().cast("string"),
            F.lit(""),
            F.col("l_orderkey").cast("string"),
            _answer_score().cast("string"),
        ).alias("value")
    )
    return asked.unionByName(given)


def _answer_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _answer_score() -> Column:
    return F.col("l_quantity").cast("int") - F.lit(25)


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as questions and line items as answers, as parsed postings."""
    none = F.lit(None)
    asked = table(spark, folder, "orders").select(
        F.lit(1).alias("post_type"),
        F.col("o_orderkey").alias("id"),
        none.cast("long").alias("accepted_answer"),
        none.cast("long").alias("parent_id"),
        F.lit(0).alias("score"),
        F.col("o_orderpriority").alias("tag"),
    )
    given = table(spark, folder, "lineitem").select(
        F.lit(2).alias("post_type"),
        _answer_id().alias("id"),
        none.cast("long").alias("accepted_answer"),
        F.col("l_orderkey").alias("parent_id"),
        _answer_score().alias("score"),
        none.cast("string").alias("tag"),
    )
    return asked.unionByName(given)


def start_centers() -> list[tuple[int, int]]:
    """Each tag at heights 0, 1 and 2."""
    return [(i * SPREAD, height) for i in range(len(VOCABULARY)) for height in range(3)]


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as survey rows with the columns the time-use job reads."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("case_id"),
        F.col("l_linenumber").alias("telfs"),
        F.when(F.col("l_suppkey") % 2 == 0, 1).otherwise(2).alias("tesex"),
        (F.col("l_partkey") % 60 + 15).alias("teage"),
        F.col("l_quantity").alias("t010101"),
        F.col("l_linenumber").cast("double").alias("t110101"),
        F.col("l_extendedprice").alias("t050101"),
        F.col("l_tax").alias("t020101"),
        F.col("l_discount").alias("t120101"),
    )


# Activities under each fixed prefix of the three classes: 400 columns in all.
WIDE_ACTIVITIES = 20


def wide_survey(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as survey rows with some hundred activity columns, as the published survey has.

    Activity ``j`` of prefix ``i`` takes ``(o_custkey + 7 i + j) % 90`` minutes.
    """
    prefixes = [*PRIMARY_PREFIXES, *WORK_PREFIXES, *OTHER_PREFIXES]
    activities = {f"{p}9{j:02d}": 7 * i + j for i, p in enumerate(prefixes) for j in range(WIDE_ACTIVITIES)}
    minutes = [((F.col("o_custkey") + more) % 90).cast("double").alias(name) for name, more in activities.items()]
    return spread(table(spark, folder, "orders").select("o_orderkey", "o_custkey")).select(
        F.col("o_orderkey").alias("case_id"),
        (F.col("o_orderkey") % 7 + 1).alias("telfs"),
        F.when(F.col("o_custkey") % 2 == 0, 1).otherwise(2).alias("tesex"),
        (F.col("o_custkey") % 60 + 15).alias("teage"),
        *minutes,
    )


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct words of the benchmark texts."""
    words = table(spark, folder, "benchmark").select(
        F.explode(space_tokens(F.col("text"))).alias("word")
    )
    return distinct_words(words)


def segment_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as replies of a segmenter; system turns are errors."""
    failed = F.col("role") == "system"
    reply = F.to_json(
        F.struct(
            F.when(failed, 1).otherwise(0).alias("ret"),
            F.when(failed, "error").otherwise("ok").alias("msg"),
            F.col("text").alias("terms"),
        )
    )
    return table(spark, folder, "conversations").select("conv_id", "turn", reply.alias("reply"))
