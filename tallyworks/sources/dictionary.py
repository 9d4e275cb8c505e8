"""The word dictionary: readers, and a copy that renews itself between batches."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyworks import storage
from tallyworks.operators.wordfreq import distinct_words
from tallyworks.session import new_folder

log = logging.getLogger(__name__)

# Fixed value: the dictionary is read again after five minutes.
DEFAULT_MAX_AGE_SECONDS = 300.0


def read_dictionary(spark: SparkSession, path: str, word: str = "word") -> DataFrame:
    """Distinct words of a Parquet table."""
    return distinct_words(spark.read.parquet(path), word)


def jdbc_dictionary_options(
    url: str, table: str = "user_words", user: str | None = None, password: str | None = None
) -> dict[str, str]:
    """Options for reading the words through JDBC; the database removes the repeats."""
    options = {"url": url, "query": f"SELECT DISTINCT word FROM {table}"}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def read_jdbc_dictionary(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return distinct_words(spark.read.format("jdbc").options(**options).load())


class RenewingDictionary:
    """The dictionary as of the last successful load, at most ``max_age`` seconds old.

    ``current`` is called at the start of a batch. Each load is written to a
    table of its own in the shared folder, so that it stays as it is when its
    source changes or goes away. If a load fails, the previous rows stay in use;
    the first load must succeed. The table before is kept for readers that are
    under way, older ones are removed.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        max_age: float = DEFAULT_MAX_AGE_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._load = load
        self._max_age = max_age
        self._clock = clock
        self._words: DataFrame | None = None
        self._paths: list[str] = []
        self._loaded_at = 0.0

    def current(self) -> DataFrame:
        now = self._clock()
        if self._words is None or now - self._loaded_at > self._max_age:
            self._renew(now)
        return self._words

    def close(self) -> None:
        """Remove the stored tables."""
        self._keep(0)
        self._words = None

    def _renew(self, now: float) -> None:
        try:
            fresh = self._load()
            spark = fresh.sparkSession
            path = new_folder(spark, "dictionary")
            fresh.write.parquet(path)
            stored = spark.read.schema(fresh.schema).parquet(path)
        except Exception:
            if self._words is None:
                raise
            log.exception("dictionary not renewed, keeping the previous one")
        else:
            self._words = stored
            self._paths.append(path)
            self._keep(2)
            log.info("dictionary stored in %s", path)
        self._loaded_at = now

    def _keep(self, newest: int) -> None:
        while len(self._paths) > newest:
            storage.remove(self._words.sparkSession, self._paths.pop(0))


class DictionaryVersions:
    """Published dictionaries, and which of them each batch was counted with.

    A batch takes the newest version at its first attempt and notes it; when
    it is replayed, it takes the noted one, whatever was published since. So a
    batch gives the same counts each time.

        words/version=<n>/
        uses/query=<q>/batch=<n>    holds the version
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")

    def publish(self, words: DataFrame, word: str = "word") -> int:
        """Store the distinct words as the next version and return its number."""
        version = max(self.versions(), default=0) + 1
        distinct_words(words, word).write.parquet(f"{self._root}/words/version={version}")
        return version

    def versions(self) -> list[int]:
        """Versions that are completely written."""
        found = storage.matching(self._spark, f"{self._root}/words/version=*/_SUCCESS")
        return sorted(int(path.rsplit("/", 2)[1].removeprefix("version=")) for path in found)

    def version_of(self, query: str, batch: int) -> int:
        """The version that a batch counts with, noted at the first call."""
        note = f"{self._root}/uses/query={query}/batch={batch}"
        if not storage.exists(self._spark, note):
            published = self.versions()
            if not published:
                raise ValueError(f"no dictionary is published in {self._root}")
            storage.write_new_text(self._spark, note, str(published[-1]))
        return int(storage.read_text(self._spark, note))

    def for_batch(self, query: str, batch: int) -> DataFrame:
        """``word`` of the version that a batch counts with."""
        return self._spark.read.schema("word STRING").parquet(f"{self._root}/words/version={self.version_of(query, batch)}")
