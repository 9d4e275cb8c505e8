"""Splitting, matching and parsing text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = "strict"
PERMISSIVE = "permissive"

_REGEX_CHARS = set(".$|()[]{}^?*+\\")


def check_mode(mode: str) -> str:
    if mode not in (STRICT, PERMISSIVE):
        raise ValueError(f"mode must be '{STRICT}' or '{PERMISSIVE}', not {mode!r}")
    return mode


def char_pattern(separator: str) -> str:
    """The one-character separator as a pattern that keeps the JVM's fast split path."""
    if len(separator) != 1:
        raise ValueError("the separator must be one character")
    return "\\" + separator if separator in _REGEX_CHARS else separator


def jvm_split(text: Column, separator: str = " ") -> Column:
    """Split like ``String.split`` does on the JVM: trailing empty pieces are dropped.

    Leading and inner empty pieces stay, ``''`` gives one empty piece, and a text
    of separators only gives none.
    """
    kept = F.rtrim(text) if separator == " " else F.rtrim(text, F.lit(separator))
    return F.when(
        (kept == "") & (text != ""), F.array().cast("array<string>")
    ).otherwise(F.split(kept, char_pattern(separator)))


def mentions(text: Column, term: str) -> Column:
    """Whether ``term`` is one of the space-separated tokens of ``text``, case-sensitive.

    Searching the space-padded text finds exactly the whole tokens without
    building an array of all tokens for each row.
    """
    if " " in term:
        return F.lit(False)
    if term == "":
        return F.array_contains(jvm_split(text), "")
    return F.concat(F.lit(" "), text, F.lit(" ")).contains(f" {term} ")


def mentioned_terms(text: Column, terms: list[str]) -> Column:
    """The array of those ``terms`` that ``text`` mentions, each at most once.

    One split serves all terms, which beats searching the text for each of them.
    """
    terms = unique_terms(terms)
    words = jvm_split(text) if "" in terms else F.split(text, " ")
    return F.array_intersect(words, F.array(*[F.lit(term) for term in terms]))


def unique_terms(terms: list[str]) -> list[str]:
    """The terms in their given order without repeats."""
    if not terms:
        raise ValueError("give at least one term")
    return list(dict.fromkeys(terms))


def all_sound(sound: Column, source: Column, what: str) -> Column:
    """A condition that holds for sound records and fails the job at any other, naming it.

    As a filter it stays whatever columns are selected later.
    """
    message = F.concat(F.lit(f"bad {what}: "), F.coalesce(source.cast("string"), F.lit("NULL")))
    return F.when(F.coalesce(sound, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )


def inside_tag(html: Column, tag: str) -> Column:
    """What stands between the first ``<tag>`` and its end, or the end of the page; NULL without the tag."""
    opening, closing = rf"<{tag}(?:\s[^>]*)?>", rf"</{tag}\s*>"
    inside = F.regexp_extract(html, rf"(?is){opening}(.*?)(?:{closing}|\z)", 1)
    return F.when(F.regexp_like(html, F.lit(rf"(?i){opening}")), inside)
