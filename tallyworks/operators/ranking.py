"""Ranking terms by the number of documents that mention them, and inverted indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import mentioned_terms, mentions, unique_terms
from tallyworks.operators.grouping import PIECE_WIDTH, collect_by_range

# The programming languages ranked by default.
DEFAULT_TERMS = [
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
]


def documents_mentioning(documents: DataFrame, term: str, text: str = "text") -> DataFrame:
    """One row ``n``: how many documents mention ``term``."""
    return documents.agg(F.count_if(mentions(F.col(text), term)).alias("n"))


def by_rank(counts: DataFrame) -> DataFrame:
    """Most frequent first; equal counts by name."""
    return counts.orderBy(F.desc("n"), "term")


def rank_terms_one_pass(
    documents: DataFrame, terms: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """Rank by one counter per term in a single scan; each task sends one row on.

    Terms no document mentions are left out.
    """
    terms = unique_terms(terms or DEFAULT_TERMS)
    counted = documents.select(mentioned_terms(F.col(text), terms).alias("_found")).agg(
        *[
            F.count_if(F.array_contains("_found", t)).alias(f"n{i}")
            for i, t in enumerate(terms)
        ]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("term"), F.col(f"n{i}").alias("n"))
            for i, t in enumerate(terms)
        ]
    )
    return by_rank(counted.select(F.inline(pairs)).where(F.col("n") > 0))


def term_index(
    documents: DataFrame,
    terms: list[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The inverted index in long form: one row ``term, doc_id`` per mention.

    Each document is read once and stays where it is; there is no join with the terms.
    """
    found = mentioned_terms(F.col(text), terms or DEFAULT_TERMS)
    return documents.select(F.explode(found).alias("term"), F.col(doc_id))


def postings_by_term(
    index: DataFrame, doc_id: str = "doc_id", width: int = PIECE_WIDTH
) -> DataFrame:
    """The index as arrays: ``term, piece, doc_ids``, a piece for each ``width`` consecutive ids."""
    return collect_by_range(index, ["term"], doc_id, "doc_ids", width=width)


def rank_from_index(index: DataFrame) -> DataFrame:
    """Rank from a long-form index."""
    return by_rank(index.groupBy("term").agg(F.count("*").alias("n")))


def rank_terms(
    documents: DataFrame, terms: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """Rank by counting mentions per term with map-side combine."""
    found = mentioned_terms(F.col(text), terms or DEFAULT_TERMS)
    mentioned = documents.select(F.explode(found).alias("term"))
    return by_rank(mentioned.groupBy("term").agg(F.count("*").alias("n")))
