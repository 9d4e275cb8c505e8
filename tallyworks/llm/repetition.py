"""Quality rules on repetition inside a document, by suffix arrays over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import encoded, slices, words_of

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"

# Fixed limits of the base rules.
LEAST_WORDS = 50
WINDOW = 3
MOST_REPEATED_PERCENT = 50

# Limits of the repeated-substring rule, from the documents that pass the base and their labels. All that is repeated in
# clean ones is a line of 8 to 13 words at head and foot: it covers up to 28 % of those of 50 to 99 words (14 % a copy), 18 %
# up to 199 words, and 9 % from there on. So short texts, where one such line weighs much, have wider shares.
LEAST_REPEAT = 8
MOST_COVERED, MOST_COVERED_SHORT = 0.15, 0.30
MOST_LONGEST, MOST_LONGEST_SHORT = 0.075, 0.15
LINE_WORDS = 13


def window_ranks(ids: np.ndarray, deep: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``ids`` and, by level, the rank of the 2^level ids from each place.

    Equal ranks of a level mean equal windows. Prefix doubling sorts only those places
    whose window is not unique yet. ``ids`` are numbers from 0, all in use. With
    ``deep`` suffixes are only sorted by so many ids, at least.
    """
    n = len(ids)
    counts = np.bincount(ids)
    starts = np.cumsum(counts) - counts
    rank = np.append(starts[ids], -1)
    open_places = np.flatnonzero(counts[ids] > 1)
    levels, h = [rank.astype(np.int32)], 1
    while len(open_places) and (deep is None or h < deep):
        after = np.minimum(open_places + h, n)
        key = rank[open_places] * (n + 1) + rank[after] + 1
        order = np.argsort(key)
        key, places = key[order], open_places[order]
        old = rank[places]
        index = np.arange(len(places))
        first_old = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), index, 0))
        new_group = np.append(True, key[1:] != key[:-1])
        first_new = np.maximum.accumulate(np.where(new_group, index, 0))
        rank[places] = old + first_new - first_old
        alone = new_group & np.append(new_group[1:], True)
        open_places = np.sort(places[~alone])
        levels.append(rank.astype(np.int32))
        h *= 2
    return np.argsort(rank[:n]), levels


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For each place the length of the longest window from it that occurs at another place, too.

    That is the larger common prefix with its neighbours in the suffix array. The
    windows so found are those of the common-prefix intervals; the ones that no
    longer window contains are the occurrences of the maximal repeats.
    """
    n = len(ids)
    if n < 2:
        return np.zeros(n, np.int64)
    suffixes, levels = window_ranks(ids)
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        at_a, at_b = np.minimum(a + common, n), np.minimum(b + common, n)
        equal = (rank[at_a] == rank[at_b]) & (at_a < n) & (at_b < n)
        common[equal] += 1 << level
    out = np.zeros(n, np.int64)
    out[a] = common
    out[b] = np.maximum(out[b], common)
    return out


def covered_by(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` places lies in one of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, starts + lengths, 1)
    return np.cumsum(edge[:n]) > 0


def _labels(texts: list[bytes], least: int) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "spans")}
    ids: list[int] = []
    ends = [0]
    base = 0
    for text in texts:
        words = words_of(text)
        # Own numbers for each document: nothing repeats across documents.
        own: dict[bytes, int] = {}
        ids += [own.setdefault(w, base + len(own)) for w in words]
        base += len(own)
        ends.append(len(ids))
        out["n_words"].append(len(words))
        letters = b"".join(words)
        out["word_chars"].append(len(letters.decode("utf-8", "replace")))
        out["n_symbols"].append(len(letters) - len(letters.translate(None, SYMBOLS)))
        lines = [x for x in text.split(b"\n") if x.translate(None, WHITE)]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    repeat = longest_repeats(np.array(ids, np.int64))
    windows = np.flatnonzero(repeat >= WINDOW)
    in_window = np.append(0, np.cumsum(covered_by(windows, np.full(len(windows), WINDOW), len(repeat))))
    long = np.flatnonzero(repeat >= least)
    inside = covered_by(long, repeat[long], len(repeat))
    in_long = np.append(0, np.cumsum(inside))
    edges = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    begins, stops = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    for a, b in zip(ends, ends[1:]):
        out["n_repeat_words"].append(int(in_window[b] - in_window[a]))
        out["covered_words"].append(int(in_long[b] - in_long[a]))
        longest = int(repeat[a:b].max()) if b > a else 0
        out["longest_repeat"].append(longest)
        spans = []
        if in_long[b] > in_long[a]:
            # Spans of neighbouring documents may touch; cut them at the document's ends.
            i = int(np.searchsorted(stops, a, side="right"))
            while i < len(begins) and begins[i] < b:
                spans.append({"start": int(max(begins[i], a) - a), "end": int(min(stops[i], b) - a)})
                i += 1
        out["spans"].append(spans)
    return out


@dataclass(frozen=True)
class Limits:
    """A document is rejected if substrings of ``least_repeat`` words or more that occur at least twice cover more than
    ``most_covered`` of it, or if its longest repeat has more than ``most_longest`` of its words.

    A line of ``line_words`` words that stands twice is no ground alone, unless the text is so short that
    it exceeds the shares ``..._short``; these hold at any length."""

    least_repeat: int = LEAST_REPEAT
    most_covered: float = MOST_COVERED
    most_longest: float = MOST_LONGEST
    most_covered_short: float = MOST_COVERED_SHORT
    most_longest_short: float = MOST_LONGEST_SHORT
    line_words: int = LINE_WORDS

    def exceeded(self, n_words: np.ndarray, covered: np.ndarray, longest: np.ndarray) -> np.ndarray:
        """Whether a document of so many words has more covered words, or a longer repeat, than it may."""

        def most(share: float, short: float, words: int) -> np.ndarray:
            return np.maximum(share * n_words, np.minimum(short * n_words, words))

        much = covered > most(self.most_covered, self.most_covered_short, 2 * self.line_words)
        return much | (longest > most(self.most_longest, self.most_longest_short, self.line_words))


def judged(texts: list[bytes], limits: Limits) -> dict[str, pa.Array]:
    """The columns that ``repetition_rules`` adds, for a block of texts."""
    found = _labels(texts, limits.least_repeat)
    spans = found.pop("spans")
    a = {k: np.array(v, np.int64) for k, v in found.items()}
    failed = (a["n_words"] < LEAST_WORDS) | (100 * a["n_repeat_words"] > MOST_REPEATED_PERCENT * a["n_words"])
    repeats = limits.exceeded(a["n_words"], a["covered_words"], a["longest_repeat"])
    columns = {k: pa.array(v) for k, v in a.items()}
    columns["spans"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    return columns | {"base_failed": pa.array(failed), "kept": pa.array(~(failed | repeats))}


def repetition_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)`` with its counts and the verdict ``kept``.

    Base counts: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (words in 3-word windows that occur twice or more). ``base_failed``: fewer
    than 50 words, or more than half of them in such windows.

    The rule of this operator: repeated substrings cover ``covered_words`` words, in the word ranges ``spans``, the longest
    has ``longest_repeat`` words, and both must keep to ``limits``.

    Null and empty texts have no words and fail the base. Repeated rows and null
    ids stay; other columns are not read; an empty table gives an empty result. No
    shuffle: each text is judged where it is read, whole, in blocks of bounded size.
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "covered_words long, longest_repeat long, spans array<struct<start: int, end: int>>, base_failed boolean, kept boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id")} | judged(encoded(part), limits))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def passing(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Those rows of ``docs`` that ``repetition_rules`` keeps, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(judged(encoded(part), limits)["kept"])

    return docs.mapInArrow(run, docs.schema)
