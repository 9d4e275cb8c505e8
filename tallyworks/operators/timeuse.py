"""Average daily hours by working status, sex and age over a wide survey table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The activity codes of each class, as column-name prefixes. A name
# belongs to the first class that has a prefix of it.
PRIMARY_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = (
    "t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18",
)

GROUP_COLUMNS = ("working", "sex", "age")
HOUR_COLUMNS = ("primaryNeeds", "work", "other")

TIME_USE_ROW = T.StructType(
    [T.StructField(name, T.StringType()) for name in GROUP_COLUMNS]
    + [T.StructField(name, T.DoubleType()) for name in HOUR_COLUMNS]
)


class ActivityColumns(NamedTuple):
    primary: list[str]
    work: list[str]
    other: list[str]


def classify_columns(
    names: list[str],
    primary: tuple[str, ...] = PRIMARY_PREFIXES,
    work: tuple[str, ...] = WORK_PREFIXES,
    other: tuple[str, ...] = OTHER_PREFIXES,
) -> ActivityColumns:
    """Sort column names into the three activity classes; the rest are left out."""
    classes = ActivityColumns([], [], [])
    for name in names:
        for members, prefixes in zip(classes, (primary, work, other)):
            if name.startswith(prefixes):
                members.append(name)
                break
    return classes


def sum_columns(columns: list[Column]) -> Column:
    """The sum over many columns; NULL if any part is NULL.

    Summed as a balanced tree, as a chain of hundreds of ``+`` nodes is too deep
    for the analyzer's recursion.
    """
    if not columns:
        raise ValueError("no columns to sum")
    if len(columns) == 1:
        return columns[0]
    half = len(columns) // 2
    return sum_columns(columns[:half]) + sum_columns(columns[half:])


def working_label(telfs: Column) -> Column:
    return F.when((telfs >= 1) & (telfs < 3), "working").otherwise("not working")


def sex_label(tesex: Column) -> Column:
    return F.when(tesex == 1, "male").otherwise("female")


def age_label(teage: Column) -> Column:
    return (
        F.when(teage.between(15, 22), "young")
        .when(teage.between(23, 55), "active")
        .otherwise("elder")
    )


def life_period_columns() -> list[Column]:
    """The three label columns; the survey must have ``telfs``, ``tesex`` and ``teage``."""
    return [
        working_label(F.col("telfs")).alias("working"),
        sex_label(F.col("tesex")).alias("sex"),
        age_label(F.col("teage")).alias("age"),
    ]


def in_labour_force(survey: DataFrame) -> DataFrame:
    return survey.where(F.col("telfs") <= 4)


def time_use_summary(
    survey: DataFrame,
    primary: list[str | Column],
    work: list[str | Column],
    other: list[str | Column],
    *keep: str,
) -> DataFrame:
    """One row per respondent in the labour force: labels, and hours per activity class."""

    def hours(columns: list[str | Column]) -> Column:
        return sum_columns([F.col(c) if isinstance(c, str) else c for c in columns]) / 60

    return in_labour_force(survey).select(
        *keep,
        *life_period_columns(),
        hours(primary).alias("primaryNeeds"),
        hours(work).alias("work"),
        hours(other).alias("other"),
    )


def summarize_survey(survey: DataFrame) -> DataFrame:
    """``time_use_summary`` with the classes taken from the survey's own column names."""
    return time_use_summary(survey, *classify_columns(survey.columns))


def time_use_grouped(summary: DataFrame) -> DataFrame:
    """Average hours per life period, rounded to one decimal, in key order."""
    return (
        summary.groupBy(*GROUP_COLUMNS)
        .agg(*[F.round(F.avg(name), 1).alias(name) for name in HOUR_COLUMNS])
        .orderBy(*GROUP_COLUMNS)
    )


def grouped_query(view: str) -> str:
    """The text of ``time_use_grouped`` as SQL over a view."""
    keys = ", ".join(GROUP_COLUMNS)
    averages = ", ".join(f"round(avg({name}), 1) AS {name}" for name in HOUR_COLUMNS)
    return f"SELECT {keys}, {averages} FROM {view} GROUP BY {keys} ORDER BY {keys}"


def time_use_grouped_sql(summary: DataFrame, view: str = "time_use_summary") -> DataFrame:
    """``time_use_grouped`` through a temporary view and a SQL text."""
    summary.createOrReplaceTempView(view)
    return summary.sparkSession.sql(grouped_query(view))


def as_time_use_rows(summary: DataFrame) -> DataFrame:
    """The summary with exactly the fixed schema; a missing column is an error."""
    missing = [name for name in TIME_USE_ROW.names if name not in summary.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return summary.select(*TIME_USE_ROW.names).to(TIME_USE_ROW)


def time_use_grouped_typed(summary: DataFrame) -> DataFrame:
    """``time_use_grouped`` from and to rows of the fixed schema."""
    return as_time_use_rows(time_use_grouped(as_time_use_rows(summary)))


def time_use_by_life_period(survey: DataFrame) -> DataFrame:
    """From the survey table to the averages."""
    return time_use_grouped(summarize_survey(survey))
