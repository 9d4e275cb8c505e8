"""Exact duplicates by recipes of content-defined chunks.

A text is cut where a rolling hash of its last bytes says so, so equal passages give
equal chunks wherever they stand. Each chunk gets an identifier, and a text becomes its recipe, the
ordered list of its chunks' identifiers. Every distinct chunk is shuffled once and compared
byte by byte with those of the same identifier; when no identifier stands for two contents, equal recipes are
equal texts, and only recipes, about one hundredth of the text, are grouped and joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import encoded, slices
from tallyworks.session import materialize

# A cut may come LEAST bytes after the last one, where CUT_BITS bits of the rolling hash are zero, and comes after MOST bytes.
LEAST, CUT_BITS, MOST = 256, 10, 8192
ID_BYTES = 16
ATTEMPTS = 6
# Bytes of chunks that a task remembers, so that it passes a common chunk on once only.
REMEMBERED = 32_000_000

WINDOW = 32  # bytes that the rolling hash looks back on
_AT_ONCE = 1_000_000
_GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_candidates(text: bytes) -> np.ndarray:
    """Places behind which the rolling hash allows a cut, each judged by the ``WINDOW`` bytes before it alone."""
    found = []
    for begin in range(0, len(text), _AT_ONCE):
        first = max(0, begin - WINDOW + 1)
        rolled = _GEAR[np.frombuffer(text, np.uint8, min(len(text), begin + _AT_ONCE) - first, first)]
        step = 1
        while step < WINDOW:  # sums over 1, 2, 4, ... bytes, the older ones shifted further
            older = rolled[:-step] << np.uint32(step)
            rolled = rolled.copy()
            rolled[step:] += older
            step *= 2
        at = np.flatnonzero(rolled[begin - first :] >> np.uint32(32 - CUT_BITS) == 0)
        found.append(at + begin + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunks_of(text: bytes) -> list[bytes]:
    """``text`` in chunks; an empty text has none."""
    ends, at = [], 0
    for c in [*cut_candidates(text).tolist(), len(text)]:
        while c - at > MOST:
            at += MOST
            ends.append(at)
        if c - at >= LEAST or (c == len(text) and c > at):
            at = c
            ends.append(at)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def recipes(docs: DataFrame, seed: int = 0, id_bytes: int = ID_BYTES) -> DataFrame:
    """``doc_id, row, text_sha256, n_chunks, recipe, fresh`` of each row of ``docs(doc_id, text)``.

    ``recipe`` holds the chunks' identifiers one after another; ``fresh`` the chunks, with their identifiers, that the
    task has not passed on lately. Texts are taken with A-Z lower-cased; null counts as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        held = 0
        for batch in batches:
            for part in slices(batch):
                lists, digests, new_ids, new_chunks, upto = [], [], [], [], [0]
                for text in encoded(part):
                    text = text.lower()  # of bytes: A-Z only
                    digests.append(hashlib.sha256(text).hexdigest())
                    ids = []
                    for chunk in chunks_of(text):
                        name = xxhash.xxh3_128_digest(chunk, seed=seed)[:id_bytes]
                        ids.append(name)
                        if known.get(name) != chunk:
                            new_ids.append(name)
                            new_chunks.append(chunk)
                            if held > REMEMBERED:
                                known.clear()
                                held = 0
                            known[name] = chunk
                            held += len(chunk)
                    lists.append(ids)
                    upto.append(len(new_ids))
                fresh = pa.StructArray.from_arrays([pa.array(new_ids, pa.binary()), pa.array(new_chunks, pa.binary())], ["id", "chunk"])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "row": part.column("row"),
                        "text_sha256": digests,
                        "n_chunks": pa.array([len(ids) for ids in lists], pa.int64()),
                        "recipe": pa.array([b"".join(ids) for ids in lists], pa.binary()),
                        "fresh": pa.ListArray.from_arrays(pa.array(upto, pa.int32()), fresh),
                    }
                )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string"),
    )
    schema = "doc_id long, row long, text_sha256 string, n_chunks long, recipe binary, fresh array<struct<id binary, chunk binary>>"
    return rows.mapInArrow(run, schema)


def ambiguous(stored: DataFrame) -> bool:
    """Whether an identifier stands for two different chunks."""
    distinct = stored.select(F.explode("fresh").alias("c")).select("c.id", "c.chunk").distinct()
    return not distinct.groupBy("id").count().where("count > 1").isEmpty()


def verified_recipes(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """The stored ``recipes``, under identifiers of which each stands for one content in the whole table.

    Should two chunks share an identifier, all chunks are named anew under another seed, and longer names if possible.
    """
    for seed in range(ATTEMPTS):
        stored = materialize(recipes(docs, seed, id_bytes), "recipes")
        if not ambiguous(stored):
            return stored
        id_bytes = min(ID_BYTES, 2 * id_bytes)
    raise RuntimeError(f"chunks with equal identifiers under {ATTEMPTS} seeds")


def exact_duplicates(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chunks`` of each row of ``docs(doc_id, text)``.

    Texts are equal when identical after lower-casing A-Z; of equal ones the row with the largest ``doc_id`` stays. Null
    texts count as empty, and all empty ones are equal. A null ``doc_id`` is smaller than any other.
    Of repeated rows one stays. A very long text is worked on in pieces of a megabyte, and its recipe
    is a hundredth of it. An empty table gives an empty result; other columns are not read. Groups are counted before they are
    shuffled, and of a large group, were it a third of all rows, Spark's skew join splits the recipes' side.
    """
    stored = verified_recipes(docs, id_bytes)
    groups = stored.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row")).alias("last"),
        F.count("*").alias("group_size"),
    )
    return (
        stored.select("doc_id", "row", "text_sha256", "n_chunks", "recipe")
        .join(groups, "recipe")
        .select(
            "doc_id",
            F.col("last.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("last.row")).alias("kept"),
            "text_sha256",
            "n_chunks",
        )
    )
