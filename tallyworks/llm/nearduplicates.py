"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A signature needs two permutations only: the first places the shingles, and the
second, shifted around by one place for each coordinate, ranks them. Documents
that share a band of coordinates are candidates; their shingle sets decide.

No step holds a bucket in one task. Documents of equal sets are one class from
the start. In a bucket, members are compared with the first and the one before
them, and what these links join is joined. Buckets that still hold several components are
compared in blocks: their members are dealt into blocks of bounded size, and a task gets
two blocks with a common bucket, compares the sets of different components, and gives
no more links than join them. So no link is given up, and pairs are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.words import WordHashes, encoded, free_name, mixed, shingle_hashes, slices, words_of
from tallyworks.session import materialize

WIDTH = 5
SIMILAR_PERCENT = 80

# A pair of similarity 0.8 misses all bands once in two million times.
BANDS, ROWS = 48, 6

# In buckets of so many members the first pairs, with the first and with the one before, are all pairs.
ALL_COMPARED = 3

# Sets of a block, and shingles in them; a task compares two blocks.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 18
_SHINGLES_AT_ONCE = 4096

_PLACE = np.uint64(0x9E3779B97F4A7C15)
_A, _B, _SHIFT = np.uint32(0x7FEB352D), np.uint32(0x846CA68B), np.uint32(15)
_COLUMNS_AT_ONCE = 2048


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a set of 64-bit hashes.

    Coordinate k is the least rank of any shingle after a shift by k places:
    min of pi(sigma(x) + k), with permutations sigma and pi of 32-bit numbers.
    """
    places = (mixed(shingles ^ _PLACE) >> np.uint64(32)).astype(np.uint32) * _A
    shifts = (np.arange(coordinates, dtype=np.uint32) * _A)[:, None]  # pi begins with a product
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), _COLUMNS_AT_ONCE):
        x = places[at : at + _COLUMNS_AT_ONCE] + shifts
        x ^= x >> _SHIFT
        x *= _B
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band, with the band's number in it."""
    rows = least.reshape(bands, -1).astype(np.uint64)
    out = np.arange(bands, dtype=np.uint64)
    for j in range(rows.shape[1]):
        out = mixed(out ^ (rows[:, j] + np.uint64(j << 32)))
    return out.view(np.int64)


def _lowered_shingles(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    return shingle_hashes(words_of(text.lower()), width, hashes)  # bytes.lower is A-Z only


def _set_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands``: a 128-bit key of the shingle set and its band keys.

    An empty set has a null key and no bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                sizes, keys, values = [], [], []
                for text in encoded(part):
                    shingles = _lowered_shingles(text, width, hashes)
                    sizes.append(len(shingles))
                    keys.append(_set_key(shingles))
                    values.append(band_keys(signature(shingles, bands * rows), bands) if len(shingles) else [])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "set_key": pa.array(keys, pa.binary()),
                        "bands": pa.array(values, pa.list_(pa.int64())),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>"
    )


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``set_key, shingles`` of each row of ``docs(text)``: the key of its set, and the sorted 64-bit hashes in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                sets = [_lowered_shingles(t, width, hashes) for t in encoded(part)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                keys = [_set_key(x) for x in sets]
                yield pa.RecordBatch.from_pydict({"set_key": pa.array(keys, pa.binary()), "shingles": values})

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "set_key binary, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs(a, b)`` whose full sets are similar: 100 * intersection >= percent * union."""
    joined = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b")), "b"
    )
    common = F.size(F.array_intersect("of_a", "of_b"))
    return joined.where((100 + percent) * common >= percent * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def joining_links(reps: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets ``left`` and ``right`` (numbers of rows) of different labels, as many as join what links at all."""
    if len(set(labels.tolist())) < 2:
        return []
    sizes = np.array([len(x) for x in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    rows, column = rows[shared], column[shared]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    at = 0
    while at < len(column):
        first = column[at]
        end = int(np.searchsorted(column, first + _SHINGLES_AT_ONCE))
        present = np.zeros((len(sets), _SHINGLES_AT_ONCE), np.float32)
        present[rows[at:end], column[at:end] - first] = 1
        common += present[left] @ present[right].T
        at = end
    enough = (100 + percent) * common >= percent * (sizes[left][:, None] + sizes[right][None, :])
    one, two = np.nonzero(enough & (labels[left][:, None] != labels[right][None, :]))
    root = {x: x for x in labels.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for i, j in zip(left[one].tolist(), right[two].tolist()):
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((int(reps[i]), int(reps[j])))
    return found


def links_in_blocks(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that join components within the buckets of ``rest(bucket, rep, n, component)``."""
    firsts = rest.groupBy("bucket").agg(F.min("rep").alias("b"))
    areas = components(rest.select("bucket", F.col("rep").alias("a")).join(firsts, "bucket").select("a", "b"))
    members = rest.select("rep", "n", "component").distinct().join(areas.select(F.col("node").alias("rep"), F.col("component").alias("area")), "rep")
    sizes = members.groupBy("area").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).alias("blocks")
    )
    members = materialize(
        members.join(sizes, "area").select("rep", "component", "area", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block")), "members"
    )
    met = rest.select("bucket", "rep").join(members, "rep").select("bucket", "area", "block").distinct()
    pairs = met.select("bucket", "area", F.col("block").alias("one")).join(met.select("bucket", F.col("block").alias("two")), "bucket")
    pairs = materialize(pairs.where("one <= two").select("area", "one", "two").distinct(), "block-pairs")
    texts = members.join(sets, "rep")
    sides = [
        texts.join(pairs.withColumn("block", F.col(side)).where("one < two" if n else "true"), ["area", "block"]).withColumn("side", F.lit(n))
        for n, side in enumerate(("one", "two"))
    ]
    columns = ["area", "one", "two", "side", "rep", "component", "shingles"]
    empty = pa.schema([("a", pa.int64()), ("b", pa.int64())]).empty_table()

    def run(rows: pa.Table) -> pa.Table:
        side = rows.column("side").to_numpy()
        left = np.flatnonzero(side == 0)
        right = left if rows.column("one")[0] == rows.column("two")[0] else np.flatnonzero(side == 1)
        values = [x.values.to_numpy() for chunk in rows.column("shingles").chunks for x in chunk]
        found = joining_links(rows.column("rep").to_numpy(), rows.column("component").to_numpy(), values, left, right, percent)
        return pa.table({"a": [x for x, _ in found], "b": [y for _, y in found]}, empty.schema) if found else empty

    return sides[0].select(columns).unionByName(sides[1].select(columns)).groupBy("area", "one", "two").applyInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of each node of ``edges(a, b)``: the smallest node that it reaches.

    Alternates joining larger neighbours, then smaller ones, to the smallest neighbour of each
    node, until every edge leads to a component's smallest node. Each round is a
    written table, and needs joins and aggregates combined on the map side.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array("a", "b")
        small = large.join(least, "a").select(F.explode(ends).alias("a"), F.col("m").alias("b")).where("a > b")
        links = materialize(small.distinct(), "links")
        # Stars: no leaf has two centers or is a center.
        uses = links.select(F.col("a").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("center")).unionByName(
            links.select(F.col("b").alias("n"), F.lit(0).alias("leaf"), F.lit(1).alias("center"))
        )
        uses = uses.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("center").alias("center"))
        if uses.where("leaf > 1 OR (leaf > 0 AND center > 0)").isEmpty():
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _can_link(one: Column, other: Column, percent: int) -> Column:
    """Whether sets of such sizes can be similar."""
    return F.least(one["n"], other["n"]) * 100 >= F.greatest(one["n"], other["n"]) * percent


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs(doc_id, text)``.

    A set is the distinct ``width``-word shingles of the text with A-Z in lower
    case (fewer words: the whole sequence as one). Documents are linked if ``percent`` of the union of
    their sets is common. ``component_id`` is the smallest id that a document reaches over links,
    ``kept`` whether that is its own.

    Null and empty texts have empty sets and are linked with nothing. Rows without an id are kept and have no component.
    Repeated rows give repeated results; an id with several texts is one document, linked by any of them. A very long
    text has a long set, which is held whole where it is made and where it is compared. Other columns are not read, an empty table gives an empty result.
    """
    signed = materialize(signatures(docs, width), "signatures")
    sets_only = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # Equal sets are one class, with a number, ``rep``; copies meet on the map side already.
    whole = sets_only.groupBy("set_key").agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    whole = materialize(whole.withColumn("rep", F.monotonically_increasing_id()), "classes")
    rows = whole.select("rep", "n", F.explode("bands").alias("bucket"))
    order = Window.partitionBy("bucket").orderBy("n", "rep")
    member = F.struct("rep", "n")
    ranked = rows.select(
        "bucket",
        member.alias("member"),
        F.row_number().over(order).alias("rank"),
        F.lag(member).over(order).alias("previous"),
        F.first(member).over(order).alias("leader"),
        F.lead("rep").over(order).alias("next"),
    )
    buckets = materialize(ranked.where("rank > 1 OR next IS NOT NULL").drop("next"), "buckets")
    wanted = whole.join(buckets.select("member.rep").distinct(), "rep", "left_semi").select("set_key", "rep", "least_id")
    own = docs.select(F.col("doc_id").cast("long").alias("least_id"), "text")
    texts = own.join(wanted.select("least_id"), "least_id", "left_semi")
    sets = materialize(shingle_sets(texts, width).join(wanted, "set_key").dropDuplicates(["set_key"]).select("rep", "shingles"), "sets")

    def as_pairs(found: DataFrame) -> DataFrame:
        """Distinct pairs, smaller number first, from columns member and other."""
        one, other = F.col("member.rep"), F.col("other.rep")
        return found.where(one != other).select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()

    near = buckets.where("rank > 1").select("member", F.explode(F.array("previous", "leader")).alias("other"))
    pairs = materialize(as_pairs(near.where(_can_link(F.col("member"), F.col("other"), percent))), "pairs")
    edges = materialize(verified(pairs, sets, percent), "edges")
    joined = components(edges)
    labelled = buckets.select("bucket", "member.rep", "member.n").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    labelled = labelled.select("bucket", "rep", "n", F.coalesce("component", "rep").alias("component"))
    sizes = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n"))
    split = sizes.where((F.col("least") < F.col("most")) & (F.col("n") > ALL_COMPARED))
    rest = materialize(labelled.join(split.select("bucket"), "bucket", "left_semi"), "rest")
    more = materialize(links_in_blocks(rest, sets, percent), "edges")
    edges = edges.unionByName(more)
    same = _of_one_id(sets_only, whole)
    if same is not None:
        edges = edges.unionByName(same)
    if same is not None or not more.isEmpty():
        joined = components(edges)
    named = whole.select("set_key", "rep", "least_id").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_key", "least_id", F.coalesce("component", "rep").alias("component"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.select("set_key", "component").join(least, "component").select("set_key", "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _of_one_id(sets_only: DataFrame, whole: DataFrame) -> DataFrame | None:
    """``a, b``: links between the sets of an id that has several; None if there is none."""
    several = sets_only.groupBy("doc_id").agg(F.min("set_key").alias("one"), F.max("set_key").alias("other")).where("one < other")
    several = materialize(several.select("doc_id"), "repeated-ids")
    if several.isEmpty():
        return None
    held = sets_only.join(several, "doc_id", "left_semi").select("doc_id", "set_key").distinct()
    held = held.join(whole.select("set_key", "rep"), "set_key").select("doc_id", "rep")
    first = held.groupBy("doc_id").agg(F.min("rep").alias("b"))
    return held.join(first, "doc_id").where("rep > b").select(F.col("rep").alias("a"), "b")


def representatives(docs: DataFrame, width: int = WIDTH, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id, and all its columns.

    Rows of equal id count as one document; of them the one with the smallest text stays. Rows without an id all stay.
    """
    judged = near_duplicates(docs, width, percent)
    gone = judged.where("NOT kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    first = Window.partitionBy("doc_id").orderBy("text")
    row = free_name(docs, "_row")
    named = left.where("doc_id IS NOT NULL").withColumn(row, F.row_number().over(first)).where(F.col(row) == 1).drop(row)
    return named.unionByName(left.where("doc_id IS NULL"))
