"""Best-fit decreasing packing of tokenized documents into sequences of bounded length.

Documents of equal length are alike to the packer, so the whole corpus is packed by
its histogram of lengths, which has no more rows than a sequence has places. The
plan says where the n-th piece of a length goes; Spark numbers the pieces of each
length and looks the plan up.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.words import encoded, slices, words_of
from tallyworks.session import materialize

CAPACITY = 2048
END_OF_DOCUMENT = 0

# Distinct units (see ``WordTokens``) whose ids a task keeps.
UNITS_KEPT = 600_000

# What the tokenizer does to text before it looks its vocabulary up, as its file says it: the shortcut of
# ``WordTokens`` is for this alone. Fixed values.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Texts of printable ASCII without apostrophes, of white space and of Latin-1 letters are normalized letter by letter and
# cut into units: runs of letters, single digits, runs of anything else. Words with other characters are units themselves.
_ASCII = bytes({*range(33, 127), *b" \t\n\x0b\x0c\r"} - {39})
_LATIN = re.compile(rb"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")
_UNITS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff\s]+")


def plain_units(text: bytes) -> list[str] | None:
    """The units of a text that can be cut so, in small letters; else None."""
    if b"<|" in text or _LATIN.fullmatch(text.translate(None, _ASCII)) is None:
        return None
    return _UNITS.findall(text.decode("utf-8").lower())


def byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(others)}


def has_known_rules(path: str) -> bool:
    """Whether a tokenizer file normalizes and splits text as ``WordTokens`` does."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    normalizer, splits = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
    steps = splits.get("pretokenizers", [])
    return (
        normalizer.get("normalizers") == _NORMALIZER
        and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        and steps[0].get("pattern") == {"Regex": _SPLIT}
        and (steps[0].get("behavior"), steps[0].get("invert")) == ("Removed", True)
        and (steps[1].get("add_prefix_space"), steps[1].get("use_regex")) == (False, False)
        and (rules.get("model") or {}).get("type") == "BPE"
    )


class _Units(dict):
    """The place of each unit's ids; an unknown unit is encoded when it is asked for."""

    def __init__(self, encode: Callable[[str | bytes], list[int]]):
        self.encode = encode
        self.flat, self.starts, self.lengths = array("I", [END_OF_DOCUMENT]), array("q", [0]), array("q", [1])

    def __missing__(self, unit: str | bytes) -> int:
        ids = self.encode(unit)
        place = self[unit] = len(self.starts)
        self.starts.append(len(self.flat))
        self.lengths.append(len(ids))
        self.flat.extend(ids)
        return place


class WordTokens:
    """Ids of texts, put together from the ids of their units.

    The tokenizer drops white space and never joins across it, nor across the cuts between units. Each distinct unit is
    encoded once, until the store is full. A tokenizer with other rules encodes each text whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.in_units = has_known_rules(path)
        self.by_byte = byte_letters()
        self.units = _Units(self._encode)

    def _encode(self, unit: str | bytes) -> list[int]:
        """Of a unit in small letters, or of a whole word."""
        if isinstance(unit, bytes):
            return self.tokenizer.encode(unit.decode("utf-8"), add_special_tokens=False).ids
        letters = unit if unit.isascii() else unit.encode("utf-8").decode("latin-1").translate(self.by_byte)
        return [t.id for t in self.tokenizer.model.tokenize(letters)]

    def _units_of(self, text: bytes) -> list[str | bytes]:
        units = plain_units(text)
        if units is not None:
            return units
        by_word = ((w, plain_units(w)) for w in words_of(text))
        return [u for w, units in by_word for u in ((w,) if units is None else units)]

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by the end id; and where each text's ids end."""
        if not self.in_units:
            coded = self.tokenizer.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
            whole = [[*c.ids, END_OF_DOCUMENT] for c in coded]
            return np.fromiter(chain.from_iterable(whole), np.uint32), np.cumsum([len(x) for x in whole])
        if len(self.units) > UNITS_KEPT:
            self.units = _Units(self._encode)
        order, counts = array("q"), []
        for text in texts:
            before = len(order)
            order.extend(map(self.units.__getitem__, self._units_of(text)))
            order.append(0)
            counts.append(len(order) - before)
        at = np.frombuffer(order, np.int64)
        lengths = np.frombuffer(self.units.lengths, np.int64)[at]
        upto = np.cumsum(lengths)
        source = np.repeat(np.frombuffer(self.units.starts, np.int64)[at] - (upto - lengths), lengths) + np.arange(int(upto[-1]))
        return np.frombuffer(self.units.flat, np.uint32)[source], upto[np.cumsum(counts) - 1]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, nth`` (and ``ids``) of the pieces of each row of ``docs(doc_id, text)``.

    A document is its ids and the end id; only one with more than ``capacity`` is
    cut, into pieces of ``capacity`` ids and a rest. ``ids_crc32`` is of the ids as little-endian unsigned
    32-bit numbers. Null and empty texts have the end id alone. ``part`` is the task, and ``nth`` numbers the pieces
    of each length in it from 0. What a task keeps of units goes with the task; a very long text is taken whole.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collecting = gc.isenabled()
        gc.disable()  # no cycles are made here, and looking for them among the units takes a fifth of the time
        try:
            yield from coded(batches)
        finally:
            if collecting:
                gc.enable()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, part_id = WordTokens(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                ids, ends = store.tokens(encoded(part))
                lengths = np.diff(ends, prepend=0)
                n_pieces = -(-lengths // capacity)
                row = np.repeat(np.arange(len(lengths)), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(lengths[row] - start, capacity)
                at = (ends - lengths)[row] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(row)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array(np.full(len(row), part_id, np.int32)),
                    "nth": pa.array(numbered(length, seen)),
                }
                if with_ids:
                    bounds = np.append(at, len(ids)).astype(np.int32)  # pieces follow each other without gaps
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length, going on from ``seen``, which is brought up to date."""
    order = np.argsort(lengths, kind="stable")
    in_order = lengths[order]
    first = np.flatnonzero(np.diff(in_order, prepend=-1))
    counts = np.diff(np.append(first, len(in_order)))
    numbers = np.empty(len(lengths), np.int64)
    numbers[order] = np.arange(len(lengths)) - np.repeat(first, counts) + seen[in_order]
    seen[in_order[first]] += counts
    return numbers


class OpenBins:
    """A segment tree over remaining capacities: is there an open bin with so much room?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # first sequence, number

    def add(self, room: int, first: int, number: int) -> None:
        if number:
            self.bins[room].append((first, number))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        found = self.bins[room].pop()
        self._mark(room)
        return found

    def _mark(self, room: int) -> None:
        at = self.leaves + room
        self.any[at] = bool(self.bins[room])
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The least room of an open bin that is at least ``length``."""
        at = self.leaves + length
        if self.any[at]:
            return length
        while at > 1 and not (at % 2 == 0 and self.any[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over all pieces: rows ``length, from_rank, to_rank, first_sequence, per_sequence, offset``.

    Pieces ``from_rank`` to ``to_rank`` (exclusive) of a length go into consecutive sequences,
    ``per_sequence`` into each, from ``offset`` on. Bins of equal history are handled together, which
    gives just what piece by piece would.
    """
    bins, plan, sequences = OpenBins(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, number = sequences, -(-(count - rank) // (capacity // length))
                sequences += number
            else:
                first, number = bins.take(room)
            each = room // length  # the bin stays the tightest one until it has no room
            filled = min(number, (count - rank) // each)
            if filled:
                plan.append((length, rank, rank + filled * each, first, each, capacity - room))
                rank += filled * each
                bins.add(room - each * length, first, filled)
            if filled < number:
                rest = count - rank
                if rest:
                    plan.append((length, rank, count, first + filled, rest, capacity - room))
                    rank = count
                    bins.add(room - rest * length, first + filled, 1)
                opened = filled + bool(rest)
                bins.add(room, first + opened, number - opened)
    return plan


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of ``token_pieces`` with ``sequence_id`` and ``offset``, best-fit decreasing over the whole table.

    Sequences are gapless from offset 0 and hold at most ``capacity`` ids. Null texts, null ids and
    repeated rows are packed like others; an empty table gives an empty result; other columns are not read. The driver sees one
    row for each length. Pieces are numbered where they are made, and tasks then get their share of the numbers of each
    length, so there is no large group, were all rows alike. The plan that is broadcast has a row for each time that a length meets a room, at
    most ``capacity`` squared and in fact some thousand.
    """
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, tokenizer, capacity, with_ids), "pieces")
    shares = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "shares")
    histogram = {r["length"]: r["n"] for r in shares.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = shares.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranked"))
    schema = "length long, from_rank long, to_rank long, first_sequence long, per_sequence long, base long"
    planned = F.broadcast(spark.createDataFrame(best_fit_plan(histogram, capacity), schema))
    return (
        pieces.join(starts, ["length", "part"])
        .withColumn("rank", F.col("ranked") + F.col("nth"))
        .join(planned, "length")
        .where((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
        .withColumn("within", F.col("rank") - F.col("from_rank"))
        .select(
            *[c for c in pieces.columns if c not in ("part", "nth")],
            F.expr("first_sequence + within div per_sequence").alias("sequence_id"),
            F.expr("base + (within % per_sequence) * length").alias("offset"),
        )
    )
