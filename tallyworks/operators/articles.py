"""Articles from marked-up lines or pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import STRICT, all_sound, check_mode, inside_tag

# The layout of an article line.
TITLE_OFFSET = 14
TITLE_END_MARKER = "</title><text>"
CLOSING_LENGTH = 16


def parse_articles(
    lines: DataFrame,
    *keep: str,
    line: str = "value",
    title_offset: int = TITLE_OFFSET,
    marker: str = TITLE_END_MARKER,
    closing_length: int = CLOSING_LENGTH,
    mode: str = STRICT,
) -> DataFrame:
    """``title, text`` of one-line articles, cut at fixed offsets around the marker.

    A line without the marker, or too short, fails in strict mode and is left
    out in permissive mode.
    """
    check_mode(mode)
    value = F.col(line)
    at = F.instr(value, marker)
    title_length = at - F.lit(1 + title_offset)
    text_start = at + F.lit(len(marker))
    text_length = F.length(value) - F.lit(closing_length) - text_start + F.lit(1)
    sound = (at > 0) & (title_length >= 0) & (text_length >= 0)
    title = F.when(sound, F.substring(value, F.lit(title_offset + 1), title_length))
    text = F.when(sound, F.substring(value, text_start, text_length))
    kept = lines.where(all_sound(sound, value, "article") if mode == STRICT else sound)
    return kept.select(*keep, title.alias("title"), text.alias("text"))


def parse_pages(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """``title, text`` of web pages by their tags; a page without a tag gives NULL, a missing end tag means the end of the page."""
    return pages.select(
        *keep,
        inside_tag(F.col(html), "title").alias("title"),
        inside_tag(F.col(html), "body").alias("text"),
    )
