"""Questions, answers, best scores and feature vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import STRICT, all_sound, check_mode
from tallyworks.operators.grouping import PIECE_WIDTH, collect_by_range
from tallyworks.operators.ranking import DEFAULT_TERMS

# The type codes of the postings.
QUESTION = 1
ANSWER = 2

# Fixed value: the distance between two neighbouring tags in a feature vector.
DEFAULT_SPREAD = 50_000

DEFAULT_VOCABULARY = DEFAULT_TERMS

POSTING_COLUMNS = ("post_type", "id", "accepted_answer", "parent_id", "score", "tag")
_OPTIONAL = ("accepted_answer", "parent_id", "tag")
_NUMBER_TYPES = {
    "post_type": "int",
    "id": "long",
    "accepted_answer": "long",
    "parent_id": "long",
    "score": "int",
}


def parse_postings(lines: DataFrame, line: str = "value", mode: str = STRICT) -> DataFrame:
    """Comma-separated postings as columns; empty optional fields become NULL.

    Strict mode fails on a record that is short or has a bad number, permissive
    mode leaves it out (see ``malformed_postings``).
    """
    check_mode(mode)
    parsed = lines.select(F.col(line).alias("_line"), *_posting_fields(F.col(line)))
    sound = ~_is_malformed()
    if mode == STRICT:
        sound = all_sound(sound, F.col("_line"), "posting")
    return parsed.where(sound).select(*POSTING_COLUMNS)


def malformed_postings(lines: DataFrame, line: str = "value") -> DataFrame:
    """The records that permissive parsing leaves out."""
    parsed = lines.select(F.col(line).alias("_line"), *_posting_fields(F.col(line)))
    return parsed.where(_is_malformed()).select(F.col("_line").alias(line))


def _posting_fields(line: Column) -> list[Column]:
    pieces = F.split(line, ",")
    fields = []
    for position, name in enumerate(POSTING_COLUMNS):
        piece = F.get(pieces, F.lit(position))
        if name in _OPTIONAL:
            piece = F.nullif(piece, F.lit(""))
            fields.append((piece.isNotNull() if name != "tag" else F.lit(False)).alias(f"_has_{name}"))
        target = _NUMBER_TYPES.get(name)
        fields.append((piece.try_cast(target) if target else piece).alias(name))
    return fields


def _is_malformed() -> Column:
    missing = F.col("post_type").isNull() | F.col("id").isNull() | F.col("score").isNull()
    unreadable = F.lit(False)
    for name in ("accepted_answer", "parent_id"):
        unreadable = unreadable | (F.col(f"_has_{name}") & F.col(name).isNull())
    return missing | unreadable


def questions(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("post_type") == QUESTION)


def answers(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("post_type") == ANSWER)


def question_answer_pairs(postings: DataFrame) -> DataFrame:
    """One row per answer with its question's columns; questions without answers drop out.

    The join is left to AQE, which splits the partition of a question that holds
    a large share of all answers.
    """
    asked = questions(postings).select(
        F.col("id").cast("long").alias("qid"), F.col("tag"), F.col("score").alias("question_score")
    )
    given = answers(postings).select(
        F.col("parent_id").cast("long").alias("qid"),
        F.col("id").alias("answer_id"),
        F.col("score").alias("answer_score"),
    )
    return asked.join(given, "qid")


def answers_by_question(postings: DataFrame, width: int = PIECE_WIDTH) -> DataFrame:
    """Answers grouped per question: ``qid, piece, answers``, a piece for each ``width`` consecutive answer ids.

    Answers are collected first, by question and piece, and their arrays then meet
    the questions. The other way round the pairs would be partitioned by
    question already, and all pieces of a hot one would lie in one task.
    """
    given = answers(postings).select(
        F.col("parent_id").cast("long").alias("qid"),
        F.col("id").alias("answer_id"),
        F.col("score").alias("answer_score"),
    )
    element = F.struct("answer_id", "answer_score")
    lists = collect_by_range(given, ["qid"], "answer_id", "answers", element, width)
    asked = questions(postings).select(F.col("id").cast("long").alias("qid"))
    return lists.join(asked, "qid", "left_semi")


def answer_counts(postings: DataFrame) -> DataFrame:
    """Number of answers per answered question: ``qid, n_answers``."""
    asked, given = _asked_and_given(postings)
    return asked.join(given, "qid").select("qid", "n_answers")


def best_answer_scores(postings: DataFrame) -> DataFrame:
    """Each answered question with its best answer score, at least 0.

    Answers are reduced to one row per question before the join, so a question
    with very many answers does not make a large partition.
    """
    asked, given = _asked_and_given(postings)
    return asked.join(given, "qid").select(
        "qid", "tag", F.greatest(F.lit(0), F.col("best")).alias("high_score")
    )


def _asked_and_given(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    asked = questions(postings).select(F.col("id").alias("qid"), "tag")
    given = (
        answers(postings)
        .groupBy(F.col("parent_id").alias("qid"))
        .agg(F.max("score").alias("best"), F.count("*").alias("n_answers"))
    )
    return asked, given


def tag_position(tag: Column, vocabulary: list[str]) -> Column:
    """0-based position of a whole tag in the ordered vocabulary, NULL if absent."""
    found = F.array_position(F.array(*[F.lit(v) for v in vocabulary]), tag)
    return F.nullif(found, F.lit(0).cast("long")).cast("int") - F.lit(1)


def feature_vectors(
    scored: DataFrame,
    vocabulary: list[str] | None = None,
    spread: int = DEFAULT_SPREAD,
    strict: bool = False,
) -> DataFrame:
    """Vectors ``qid, lx, hs`` from scored questions.

    Questions whose tag is unknown or missing are dropped; with ``strict`` they fail the job.
    """
    position = tag_position(F.col("tag"), vocabulary or DEFAULT_VOCABULARY)
    known = all_sound(position.isNotNull(), F.col("tag"), "tag") if strict else position.isNotNull()
    return scored.where(known).select(
        "qid", (position * F.lit(spread)).alias("lx"), F.col("high_score").cast("int").alias("hs")
    )


def unknown_tags(scored: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """How many scored questions ``feature_vectors`` drops, per tag."""
    position = tag_position(F.col("tag"), vocabulary or DEFAULT_VOCABULARY)
    return scored.where(position.isNull()).groupBy("tag").agg(F.count("*").alias("n"))


def vectors_from_postings(
    postings: DataFrame,
    vocabulary: list[str] | None = None,
    spread: int = DEFAULT_SPREAD,
) -> DataFrame:
    """``feature_vectors(best_answer_scores(postings))`` in one scan and one shuffle.

    Questions and answers meet under the question's id as partial aggregates of
    fixed width, so there is no join, and a hot question is combined on the map side.
    """
    lx = tag_position(F.col("tag"), vocabulary or DEFAULT_VOCABULARY) * F.lit(spread)
    is_question = F.col("post_type") == QUESTION
    is_answer = F.col("post_type") == ANSWER
    return (
        postings.where(is_question | is_answer)
        .groupBy(F.when(is_question, F.col("id")).otherwise(F.col("parent_id")).alias("qid"))
        .agg(
            F.max(F.when(is_question, lx)).alias("lx"),
            F.max(F.when(is_answer, F.col("score"))).alias("best"),
        )
        .where(F.col("lx").isNotNull() & F.col("best").isNotNull())
        .select("qid", "lx", F.greatest(F.lit(0), F.col("best")).cast("int").alias("hs"))
    )
