"""Word counts and per-key totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import jvm_split


def lines_of(texts: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of a multi-line text column, in a column ``value``."""
    return texts.select(*keep, F.explode(F.split(F.col(text), "\n")).alias("value"))


def words_of(lines: DataFrame, *keep: str, line: str = "value", separator: str = " ") -> DataFrame:
    """One row per word of each line, in a column ``word``."""
    return lines.select(*keep, F.explode(jvm_split(F.col(line), separator)).alias("word"))


def count_by(rows: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def word_count(lines: DataFrame, line: str = "value", separator: str = " ") -> DataFrame:
    """How often each word occurs: ``word, n``."""
    return count_by(words_of(lines, line=line, separator=separator), "word")


def totals_by_key(
    rows: DataFrame, key: str, amount: str, decimals: int | None = None
) -> DataFrame:
    """Total, number of months and average of ``amount`` per key.

    ``decimals`` rounds the total before it is divided, so that amounts of money
    give the same result in whatever order their parts were added.
    """
    value = F.col(amount).cast("double")
    total = F.sum(value) if decimals is None else F.round(F.sum(value), decimals)
    return (
        rows.groupBy(key)
        .agg(total.alias("total"), F.count(value).alias("months"))
        .withColumn("average", F.col("total") / F.col("months"))
    )


def nested_totals_by_key(
    rows: DataFrame, key: str, amount: str, decimals: int | None = None
) -> DataFrame:
    """The same as a pair: the key and a struct of total and average."""
    return totals_by_key(rows, key, amount, decimals).select(
        key, F.struct("total", "average").alias("income")
    )
