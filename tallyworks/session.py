"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tallyworks import storage

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}
# What this process has stored for each application and not dropped yet: paths, and tables held in executors.
_owned: dict[str, list[str | DataFrame]] = {}


def build_session(
    app_name: str = "tallyworks",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are designed for.

    AQE merges small shuffle partitions and splits skewed ones, so on a cluster
    ``shuffle_partitions`` should be generous (a few per core of the cluster).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors can reach, or None when the cluster names none.

    Only a local-mode session without the setting gets a folder of its own; a
    cluster never falls back to a machine-local one.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return None
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tallyworks-")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    root = shared_folder(spark)
    if root is None:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    _stored_of(spark).append(path)
    return path


def _stored_of(spark: SparkSession) -> list[str | DataFrame]:
    return _owned.setdefault(spark.sparkContext.applicationId, [])


def drop_stored(spark: SparkSession, keep: int = 0) -> int:
    """Delete the folders and tables stored so far, but for the first ``keep``; returns how many were there.

    Results that read them can't be read any more afterwards.
    """
    owned, dropped = _stored_of(spark), 0
    while len(owned) > keep:
        stored = owned.pop()
        if isinstance(stored, str):
            dropped += storage.remove(spark, stored)
        else:
            stored.unpersist()
            dropped += 1
    return dropped


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[None]:
    """Own what is stored inside: it is deleted at the end, also when a query fails.

    Read or write the result inside. Without such a scope stored tables stay until
    ``drop_stored``, as results are read when the caller likes.
    """
    before = len(_stored_of(spark))
    try:
        yield
    finally:
        drop_stored(spark, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once and read back as a stored table, for loops that reuse it.

    A stored table outlives the executors that wrote it. Without a shared folder
    the rows are persisted instead; Spark recomputes lost blocks from lineage.
    Put a query and the reading of its result into ``stored_tables`` to have both deleted.
    """
    spark = df.sparkSession
    if shared_folder(spark) is None:
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        _stored_of(spark).append(held)
        return held
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
