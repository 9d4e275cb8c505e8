"""Text lines, wide survey files and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.text import STRICT, all_sound, char_pattern, check_mode


def read_lines(spark: SparkSession, path: str | list[str], line_separator: str | None = None) -> DataFrame:
    """One row ``value`` per line. A missing path is an error.

    Lines end at a line feed, a carriage return or both, or at ``line_separator`` alone.
    """
    return spark.read.text(path, lineSep=line_separator)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def from_rows(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(rows, schema)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, dealt out evenly before costly work per row.

    A large table has splits enough and is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The files of a Parquet table as a stream.

    The path is a pattern because the file source takes a plain path to be a
    directory, and a table may be a single file.
    """
    path = f"{folder}/{name}.[p]arquet"
    reader = spark.readStream.schema(read_table(spark, folder, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def survey_schema(names: list[str]) -> T.StructType:
    """First column text (the case id), all others numbers."""
    return T.StructType(
        [T.StructField(names[0], T.StringType())]
        + [T.StructField(name, T.DoubleType()) for name in names[1:]]
    )


def read_survey(
    spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False
) -> tuple[list[str], DataFrame]:
    """Column names and rows of a CSV file with a header.

    Without a schema one is made from the header line alone; ``infer`` instead
    reads the whole file once more to find the types. A later file whose header
    differs, be it in order only, fails the job.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if infer:
        survey = reader.option("inferSchema", True).csv(path)
    else:
        survey = reader.csv(path, schema=schema or survey_schema(reader.csv(path).columns))
    return survey.columns, survey


def survey_rows(
    lines: DataFrame,
    names: list[str],
    line: str = "value",
    separator: str = ",",
    mode: str = STRICT,
) -> DataFrame:
    """Lines of separated fields as rows of ``survey_schema(names)``.

    A missing field or bad number fails in strict mode and gives NULL in permissive mode.
    A line is split once and its numbers are read once, into an array: written out for
    hundreds of columns, each with a split of its own, the code could not be compiled.
    The array comes out of ``explode`` so that Spark moves no filter on a column before it, where it would split and read the line again.
    """
    check_mode(mode)
    fields = lines.select(F.col(line).alias("_line"), F.split(F.col(line), char_pattern(separator)).alias("_fields"))
    numbers = F.slice("_fields", 2, max(1, len(names) - 1)).try_cast("array<double>")
    read = fields.select("_line", "_fields", F.explode(F.array(numbers)).alias("_numbers"))
    if mode == STRICT:
        whole = F.size("_fields") >= len(names)
        sound = whole & ~F.exists("_numbers", lambda n: n.isNull()) if len(names) > 1 else whole
        read = read.where(all_sound(sound, F.col("_line"), "survey row"))
    return read.select(
        F.get("_fields", F.lit(0)).alias(names[0]),
        *[F.get("_numbers", F.lit(i)).alias(name) for i, name in enumerate(names[1:])],
    )
