"""A table of word counts that batches add to, each exactly once.

Every batch is written as a delta of its own, at a path made from the query and
batch number, so a replayed batch overwrites itself. Compaction folds the deltas of one
month into a new base. A log of manifests says which base of each month is
current and which batches of each query are in it; the newest manifest holds.
Readers resolve it to a list of paths once, so what is compacted afterwards does not
change what they read, and they open no file of another month.

    deltas/query=<q>/batch=<n>/month=<yyyyMM>/
    bases/month=<yyyyMM>/version=<v>/
    log/<number>.json
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import storage
from tallyworks.functions.times import MONTH_FORMAT

_DELTA_SCHEMA = "word STRING, date DATE, n LONG, query STRING, batch LONG, month STRING"
_BASE_SCHEMA = "word STRING, date DATE, n LONG, month STRING, version LONG"
_DELTA_PATH = re.compile(r"/query=([^/]+)/batch=(\d+)(?:/month=([^/]+))?$")
_BASE_PATH = re.compile(r"/month=([^/]+)/version=(\d+)$")
# Manifests that are kept behind the newest one.
_OLD_MANIFESTS = 2


class Manifest:
    """What holds as of one entry of the log: ``bases[month]`` is a version, ``folded[month][query]`` the last batch in it."""

    def __init__(self, number: int, bases: dict[str, int], folded: dict[str, dict[str, int]]) -> None:
        self.number, self.bases, self.folded = number, bases, folded

    def has(self, month: str, query: str, batch: int) -> bool:
        """Whether a batch is in the month's base."""
        return batch <= self.folded.get(month, {}).get(query, -1)

    def after(self, month: str, closed: dict[str, int]) -> Manifest:
        bases = {**self.bases, month: self.bases.get(month, 0) + 1}
        return Manifest(self.number + 1, bases, {**self.folded, month: {**self.folded.get(month, {}), **closed}})


class WordTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")

    def add_batch(self, counts: DataFrame, query: str, batch: int) -> None:
        """Add ``word, date, n`` to the table; a batch number of a query counts once.

        A failed write fails the batch, and its offsets are then not committed.
        """
        (
            counts.groupBy("word", "date")
            .agg(F.sum("n").cast("long").alias("n"))
            .withColumn("month", F.date_format("date", MONTH_FORMAT))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("month")
            .parquet(f"{self._root}/deltas/query={query}/batch={batch}")
        )

    def counts(self, month: str | None = None) -> DataFrame:
        """The table as it stands now: one row ``word, date, n`` per word and day."""
        manifest = self.manifest()
        return self._added(self._open_deltas(manifest, month), self._bases(manifest, month))

    def months(self) -> list[str]:
        """Months with data, folded or not; one entry per month of history."""
        return sorted({month for _, _, month in self._deltas()} | self.manifest().bases.keys())

    def manifest(self) -> Manifest:
        """The newest entry of the log."""
        found = storage.matching(self._spark, f"{self._root}/log/*.json")
        if not found:
            return Manifest(0, {}, {})
        said = json.loads(storage.read_text(self._spark, found[-1]))
        return Manifest(int(found[-1].rsplit("/", 1)[1].removesuffix(".json")), said["bases"], said["folded"])

    def compact(self, month: str) -> int:
        """Fold the deltas of ``month`` into a new base version, and return its number.

        The newest batch of each query stays open, as it may still be replayed.
        Of two compactions at a time one is entered in the log, the other fails.
        """
        before = self.manifest()
        closed = {query: newest - 1 for query, newest in self._newest().items()}
        after = before.after(month, closed)
        version = after.bases[month]
        self.to_fold(before, month, closed).write.mode("overwrite").parquet(
            f"{self._root}/bases/month={month}/version={version}"
        )
        entry = json.dumps({"bases": after.bases, "folded": after.folded}, sort_keys=True)
        if not storage.write_new_text(self._spark, f"{self._root}/log/{after.number:012d}.json", entry):
            raise RuntimeError(f"another compaction of {self._root} was faster")
        return version

    def to_fold(self, manifest: Manifest, month: str, closed: dict[str, int]) -> DataFrame:
        """The next base of ``month``: its base and its open deltas up to the closed batches."""
        deltas = [d for d in self._open_deltas(manifest, month) if d[1] <= closed.get(d[0], -1)]
        return self._added(deltas, self._bases(manifest, month))

    def compact_all(self) -> None:
        """Compact every month that has deltas, then remove what no reader needs any more."""
        for month in sorted({month for _, _, month in self._deltas()}):
            self.compact(month)
        self.remove_folded()

    def remove_folded(self) -> int:
        """Delete folded deltas, bases that are not current, and old manifests; returns how many folders.

        To be called while nobody reads the table: a read under way may still
        want the files.
        """
        manifest, newest = self.manifest(), self._newest()
        months: dict[tuple[str, int], set[str]] = {}
        for query, batch, month in self._deltas():
            months.setdefault((query, batch), set()).add(month)
        gone = [
            f"{self._root}/deltas/query={query}/batch={batch}"
            for (query, batch), held in months.items()
            if batch < newest[query] and all(manifest.has(month, query, batch) for month in held)
        ]
        for path in storage.matching(self._spark, f"{self._root}/bases/month=*/version=*"):
            month, version = _BASE_PATH.search(path).groups()
            if int(version) < manifest.bases.get(month, 0):
                gone.append(path)
        for path in storage.matching(self._spark, f"{self._root}/log/*.json")[: -1 - _OLD_MANIFESTS]:
            storage.remove(self._spark, path)
        return sum(storage.remove(self._spark, path) for path in gone)

    def _newest(self) -> dict[str, int]:
        """The newest batch of each query, from folder names."""
        newest: dict[str, int] = {}
        for path in storage.matching(self._spark, f"{self._root}/deltas/query=*/batch=*"):
            query, batch, _ = _DELTA_PATH.search(path).groups()
            newest[query] = max(int(batch), newest.get(query, -1))
        return newest

    def _deltas(self, month: str | None = None) -> list[tuple[str, int, str]]:
        """``query, batch, month`` of the deltas, from folder names; a batch that is being written has none yet."""
        pattern = f"{self._root}/deltas/query=*/batch=*/month={month or '*'}"
        found = (_DELTA_PATH.search(path).groups() for path in storage.matching(self._spark, pattern))
        return [(query, int(batch), month) for query, batch, month in found]

    def _open_deltas(self, manifest: Manifest, month: str | None) -> list[tuple[str, int, str]]:
        return [(q, b, m) for q, b, m in self._deltas(month) if not manifest.has(m, q, b)]

    def _bases(self, manifest: Manifest, month: str | None) -> list[tuple[str, int]]:
        return [(m, v) for m, v in sorted(manifest.bases.items()) if month in (None, m)]

    def _added(self, deltas: list[tuple[str, int, str]], bases: list[tuple[str, int]]) -> DataFrame:
        delta_paths = [f"{self._root}/deltas/query={q}/batch={b}/month={m}" for q, b, m in deltas]
        base_paths = [f"{self._root}/bases/month={m}/version={v}" for m, v in bases]
        parts = self._read("deltas", _DELTA_SCHEMA, delta_paths).unionByName(self._read("bases", _BASE_SCHEMA, base_paths))
        return parts.groupBy("word", "date").agg(F.sum("n").alias("n"))

    def _read(self, part: str, schema: str, paths: list[str]) -> DataFrame:
        if paths:
            rows = self._spark.read.schema(schema).option("basePath", f"{self._root}/{part}").parquet(*paths)
        else:
            rows = self._spark.createDataFrame([], schema)
        return rows.select("word", "date", "n")
