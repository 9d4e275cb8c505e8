"""How many records mention each word of a dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import jvm_split


def space_tokens(text: Column) -> Column:
    """The default tokenizer; an empty record has no words."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(jvm_split(text))


def reply_tokens(reply: Column) -> Column:
    """Distinct words of a JSON reply with number ``ret`` 0 and texts ``msg`` and ``terms``; any other reply has none.

    A caller with a segmenting service passes this over its replies as the tokenizer.
    """
    parsed = F.try_parse_json(reply)

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))

    number = kind("$.ret").rlike("^(BIGINT|FLOAT|DOUBLE|DECIMAL.*)$")
    texts = (kind("$.msg") == "STRING") & (kind("$.terms") == "STRING")
    complete = number & texts & (F.try_variant_get(parsed, "$.ret", "double") == 0)
    terms = F.try_variant_get(parsed, "$.terms", "string")
    return F.when(complete, F.array_distinct(jvm_split(terms))).otherwise(
        F.array().cast("array<string>")
    )


def distinct_words(table: DataFrame, word: str = "word") -> DataFrame:
    """The dictionary: distinct words of a table."""
    return table.select(F.col(word).alias("word")).where(F.col("word").isNotNull()).distinct()


def words_in_records(records: DataFrame, *keep: str | Column, tokens: Column) -> DataFrame:
    """One row per record and distinct token, in a column ``word``."""
    return records.select(*keep, F.explode(F.array_distinct(tokens)).alias("word"))


def dictionary_hits(
    records: DataFrame, dictionary: DataFrame, *keep: str | Column, tokens: Column
) -> DataFrame:
    """One row per record and dictionary word in it, each word at most once per record.

    Spark broadcasts the dictionary where its size allows. Otherwise it joins by
    word, and AQE splits frequent words if the dictionary is a stored table, as those of
    ``sources.dictionary`` are: words that come out of an aggregate are grouped already and can't be split.
    """
    found = words_in_records(records, *keep, tokens=tokens)
    return found.join(dictionary, "word", "left_semi").select(*found.columns)


def dictionary_counts(
    records: DataFrame, dictionary: DataFrame, *keys: str | Column, tokens: Column
) -> DataFrame:
    """Number of records that mention each dictionary word: ``word, n``, also per ``keys``.

    Words are counted before the join, so it sees each word once however
    frequent it is. Spark moves the join below the count only where it can
    broadcast the dictionary.
    """
    found = words_in_records(records, *keys, tokens=tokens)
    counted = found.groupBy(*found.columns).agg(F.count("*").alias("n"))
    return counted.join(dictionary, "word", "left_semi").select(*found.columns, "n")
