"""Streaming dictionary word frequency into the additive word table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.wordfreq import dictionary_counts, space_tokens
from tallyworks.sinks.wordtable import WordTable
from tallyworks.sources.dictionary import DictionaryVersions, RenewingDictionary
from tallyworks.streaming.runtime import WORD_INTERVAL, BatchHandler, start_batches


def start_word_frequency(
    records: DataFrame,
    dictionary: RenewingDictionary | DictionaryVersions,
    table: WordTable,
    query: str,
    checkpoint: str,
    text: str = "value",
    tokenizer: Callable[[Column], Column] = space_tokens,
    date: Column | None = None,
    input_partitions: int | None = None,
    every: str | None = WORD_INTERVAL,
    wrap: Callable[[BatchHandler], BatchHandler] | None = None,
) -> StreamingQuery:
    """Count in how many records each dictionary word occurs, and add to the table.

    ``date`` is the day a record counts for, the day of processing by default.
    ``query`` names the checkpoint's lineage of batches: a new checkpoint needs
    a new name. ``input_partitions`` spreads the records of few topic partitions.
    A renewing dictionary is the newest at each attempt of a batch; with versions, a replayed
    batch counts with the one of its first attempt.
    """
    day = F.current_date() if date is None else date
    tokens = tokenizer(F.col(text))
    spread = records.repartition(input_partitions) if input_partitions else records

    def add(batch: DataFrame, number: int) -> None:
        versioned = isinstance(dictionary, DictionaryVersions)
        words = dictionary.for_batch(query, number) if versioned else dictionary.current()
        counts = dictionary_counts(
            batch, words, day.cast("date").alias("date"), tokens=tokens
        )
        table.add_batch(counts, query, number)

    return start_batches(spread, add, checkpoint, every, wrap=wrap)
