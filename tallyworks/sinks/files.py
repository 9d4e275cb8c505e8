"""Text and CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows of a survey file: some hundred columns make about 100 MB of text, as much as one task reads of a plain file.
SURVEY_FILE_ROWS = 50_000


def save_survey(survey: DataFrame, path: str, header: bool = False) -> None:
    """A wide survey as CSV files that ``read_survey`` and ``read_lines`` take as they are.

    Compressed, as hundreds of small numbers are mostly digits and separators. A compressed file is read by one task,
    so each has a bounded number of rows.
    """
    writer = survey.write.option("header", header).option("maxRecordsPerFile", SURVEY_FILE_ROWS)
    writer.csv(path, compression="lz4")


def save_as_text(df: DataFrame, path: str, files: int | None = None) -> None:
    """Each row as a tuple-like line ``(a,b,c)``.

    ``files`` sets the number of output files; 1 suits only small results. The
    rows are computed in parallel before they are brought together.
    """
    line = F.concat(
        F.lit("("),
        F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]),
        F.lit(")"),
    )
    lines = df.select(line.alias("value"))
    if files:
        lines = lines.repartition(files)
    lines.write.text(path)


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows a batch offers, for printing."""
    return df.limit(rows)
