"""Small files and folders in any store that Spark reaches, through its own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order; none where a folder on the way is missing."""
    files, place = _opened(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(place) or [])


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _opened(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if there was none."""
    files, place = _opened(spark, path)
    return files.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small UTF-8 file."""
    files, place = _opened(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small UTF-8 file that appears whole or not at all; False if it is there already."""
    files, place = _opened(spark, path)
    if files.exists(place):
        return False
    files, staged = _opened(spark, f"{place.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = files.create(staged, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(staged, place):
        files.delete(staged, False)
        return False
    return True
