"""A Merkle manifest of a table: a tree for each group, a root over the groups' trees, and a proof for each row.

Leaves stand in the order of their ids, but no rows are sorted for it. Ids are kept as bitmaps, 64 ids to a word and
empty words left out, that partial aggregation merges. A directory of counts over ever
longer runs of words says how many rows come before a word; the rank of an id is that number and the count of lower bits in
its word. With its rank each leaf has a slot in a block of 4096; blocks are reduced by four levels of eight at a time,
and paths from the root are handed down block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.words import free_name
from tallyworks.session import materialize

WIDTH = 8
# Levels of the tree that one block of slots holds.
LEVELS = 4
# A directory entry covers so many bits more than the ones below it; a directory of few entries needs none above.
DIRECTORY_BITS, FEW_ENTRIES = 9, 4096

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are ids shifted right by 6, so none is as low as this one: null ids are held to come first.
_NULL_WORD = -(1 << 60)


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256, as hex text, of the values: ``-`` for null, else UTF-8 bytes, a colon and the value."""

    def said(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[said(v) for v in values]), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_needed(nodes: int) -> int:
    """Levels until one node remains."""
    levels = 0
    while nodes > 1:
        nodes = -(-nodes // WIDTH)
        levels += 1
    return levels


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows`` with ``at``, their place in ``order``; equal rows stand in any order, dealt out by a hash of theirs."""
    columns, salt = rows.columns, free_name(rows, "_salt")
    rows = materialize(rows.withColumn(salt, F.xxhash64(F.monotonically_increasing_id())), "salted")
    by = [F.col(c).asc_nulls_first() for c in [*order, salt]]
    in_order = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    in_order = in_order.select(*columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    stored = materialize(in_order, "numbered")
    parts = stored.groupBy("_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return stored.join(starts, "_part").select(*columns, (F.col("_start") + F.col("_id") - F.col("_first")).alias("at"))


def _directory(entries: DataFrame) -> DataFrame:
    """``tree, word, rows, start, total``: rows of the tree before each entry, and in all, from ``tree, word, rows``."""
    parent = F.shiftright("word", DIRECTORY_BITS)
    longest = entries.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    if longest <= FEW_ENTRIES:
        whole = Window.partitionBy("tree")
        before = whole.orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
        return entries.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).withColumn("total", F.sum("rows").over(whole))
    above = materialize(entries.groupBy("tree", parent.alias("word")).agg(F.sum("rows").alias("rows")), "directory")
    above = _directory(above).select("tree", F.col("word").alias("parent"), F.col("start").alias("base"), "total")
    before = Window.partitionBy("tree", "parent").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    return (
        entries.withColumn("parent", parent)
        .withColumn("own", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .join(above, ["tree", "parent"])
        .select("tree", "word", "rows", (F.col("base") + F.col("own")).alias("start"), "total")
    )


def ranked(rows: DataFrame) -> DataFrame:
    """Stored ``rows(tree, id, leaf, ...)`` with ``place``, from 0, by ``id`` and then ``leaf`` in each tree, and ``total``, the tree's rows.

    Null ids come first. Rows of equal id and leaf are placed in any order.
    """
    columns = rows.columns
    # word and bit of an id; a null id is the only one of its word
    rows = rows.withColumn("word", F.coalesce(F.shiftright("id", 6), F.lit(_NULL_WORD))).withColumn(
        "low", F.coalesce(F.col("id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    )
    words = rows.groupBy("tree", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, low)")).alias("bits"),
        F.count("*").alias("rows"),
    )
    words = materialize(words, "bitmap")
    directory = _directory(words.select("tree", "word", "rows")).drop("rows")
    lookup = words.join(directory, ["tree", "word"])
    place = F.expr("start + bit_count(bits & ~shiftleft(-1L, low))")
    if words.where(F.col("rows") > F.bit_count("bits")).isEmpty():
        return rows.join(lookup, ["tree", "word"]).select(*columns, place.alias("place"), "total")
    # Ids of several rows: a word lists how many more rows than one its ids have, and the rows of such an id are numbered.
    again = rows.groupBy("tree", "word", "low").agg(F.count("*").alias("n")).where("n > 1")
    again = materialize(again, "repeated-ids")
    more = again.groupBy("tree", "word").agg(F.collect_list(F.struct("low", (F.col("n") - 1).alias("more"))).alias("repeats"))
    lookup = lookup.join(more, ["tree", "word"], "left")
    unique = rows.join(again, ["tree", "word", "low"], "left_anti").withColumn("nth", F.lit(0).cast("long"))
    copies = _numbered(rows.join(again.drop("n"), ["tree", "word", "low"]).select(*columns, "word", "low"), ["tree", "word", "low", "leaf"])
    first = copies.groupBy("tree", "word", "low").agg(F.min("at").alias("first"))
    copies = copies.join(first, ["tree", "word", "low"]).withColumn("nth", F.col("at") - F.col("first")).drop("at", "first")
    extra = F.expr("aggregate(filter(repeats, r -> r.low < low), 0L, (sum, r) -> sum + r.more)")
    place = place + F.coalesce(extra, F.lit(0)) + F.col("nth")
    return unique.unionByName(copies).join(lookup, ["tree", "word"]).select(*columns, place.alias("place"), "total")


class Block:
    """Up to ``WIDTH ** LEVELS`` consecutive nodes of a tree and the levels above them, ``levels`` of them."""

    def __init__(self, nodes: list[str], levels: int):
        self.rows = [nodes]
        for _ in range(levels):
            below = self.rows[-1]
            self.rows.append([digest(below[i : i + WIDTH]) for i in range(0, len(below), WIDTH)])

    @property
    def top(self) -> str:
        return self.rows[-1][0]

    def runs(self, slot: int, first_level: int = 0) -> list[tuple[int, list[str]]]:
        """Upwards from ``first_level``: the place in its run, and the run, of the node over ``slot``."""
        out = []
        for level in range(first_level, len(self.rows) - 1):
            at = slot // WIDTH**level
            first = at - at % WIDTH
            out.append((at % WIDTH, self.rows[level][first : first + WIDTH]))
        return out


def others(runs: list[tuple[int, list[str]]]) -> list[str]:
    return [d for at, run in runs for i, d in enumerate(run) if i != at]


def fold(node: str, runs: list[tuple[int, list[str]]]) -> str:
    for at, run in runs:
        node = digest([*run[:at], node, *run[at + 1 :]])
    return node


def _joined(digests: list[str]) -> bytes:
    return bytes.fromhex("".join(digests))


def _split(joined: bytes) -> list[str]:
    text = joined.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


_PATH = "path array<struct<at: int, run: binary>>"


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One block at a time as Python values."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _blocks(nodes: DataFrame) -> DataFrame:
    """Stored blocks ``tree, block, total, levels, ids, leaves, changed, top`` of ``nodes(tree, place, total, id, leaf, changed)``.

    ``leaves`` are the digests by slot, ``changed`` those of changed leaves, or nothing, in as many entries.
    """
    size = WIDTH**LEVELS

    def run(table: pa.Table) -> pa.Table:
        total, n = table.column("total")[0].as_py(), table.num_rows
        by_slot = np.empty(n, np.int64)
        by_slot[table.column("place").to_numpy() % size] = np.arange(n)
        table = table.take(pa.array(by_slot))
        leaves = [d.hex() for d in table.column("leaf").to_pylist()]
        levels = min(LEVELS, levels_needed(total))
        return pa.table(
            {
                "tree": table.column("tree")[:1],
                "block": table.column("block")[:1],
                "total": table.column("total")[:1],
                "levels": pa.array([levels], pa.int32()),
                "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
                "leaves": pa.array([_joined(leaves)], pa.binary()),
                "changed": pa.array([table.column("changed").to_pylist()], pa.list_(pa.binary())),
                "top": pa.array([bytes.fromhex(Block(leaves, levels).top)], pa.binary()),
            }
        )

    schema = "tree string, block long, total long, levels int, ids array<long>, leaves binary, changed array<binary>, top binary"
    placed = nodes.select("tree", F.expr(f"place div {size}").alias("block"), "total", "place", "id", "leaf", "changed")
    return materialize(placed.groupBy("tree", "block").applyInArrow(run, schema), "merkle-blocks")


def _next(blocks: DataFrame) -> DataFrame:
    """The tops of blocks as nodes."""
    total = F.expr(f"(total + {WIDTH**LEVELS - 1}) div {WIDTH**LEVELS}")
    none = F.lit(None)
    return blocks.select(
        "tree", F.col("block").alias("place"), total.alias("total"), none.cast("long").alias("id"), F.col("top").alias("leaf"), none.cast("binary").alias("changed")
    )


def _reduced(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of ``nodes``, of their tops, and so on until every tree has one top."""
    rounds = [_blocks(nodes)]
    while not rounds[-1].where("block > 0").isEmpty():
        rounds.append(_blocks(_next(rounds[-1])))
    return rounds


def _handed_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``tree, block, path, subroot`` of each node of ``blocks``, whose own blocks have the paths and subroots of ``above``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                leaves = _split(row["leaves"])
                block = Block(leaves, row["levels"])
                first = row["block"] * WIDTH**LEVELS
                for begin in range(0, len(leaves), 256):
                    slots = range(begin, min(len(leaves), begin + 256))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "tree": pa.array([row["tree"]] * len(slots), pa.string()),
                            "block": pa.array([first + s for s in slots], pa.int64()),
                            "path": pa.array(
                                [[{"at": a, "run": _joined(r)} for a, r in block.runs(s)] + row["path"] for s in slots],
                                pa.list_(pa.struct([("at", pa.int32()), ("run", pa.binary())])),
                            ),
                            "subroot": pa.array([row["subroot"]] * len(slots), pa.string()),
                        }
                    )

    joined = blocks.select("tree", "block", "levels", "leaves").join(above, ["tree", "block"])
    return joined.mapInArrow(run, f"tree string, block long, {_PATH}, subroot string")


def manifest(leaves: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row of ``leaves(tree, id, leaf, changed)``.

    ``tree`` names the group, a string or null, and ``leaf`` is a binary digest; ``changed`` is the digest that a tampered row has now, or null.
    Leaves stand by ``id``, null first, then by digest. Every eight consecutive nodes of a level become the digest of
    their hex texts, the last run of fewer too, until one is left: the tree's subroot. The subroots, by the bytes of
    ``tree`` and null first, are reduced likewise to the root. ``proof_sha256`` is the digest of the siblings on the way to the root;
    ``folded_root`` is recomputed with them, and ``verified`` tells if it is the root.
    """
    named = F.when(F.col("tree").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "tree"))  # null before all, in the same order
    stored = materialize(leaves.select(named.alias("tree"), F.col("id").cast("long").alias("id"), "leaf", "changed"), "leaves")
    rounds = _reduced(ranked(stored))
    subroots = rounds[-1].select("tree", F.col("top").alias("leaf"))
    # The tree over the subroots, whose rows are one for each group.
    order = materialize(_numbered(subroots, ["tree"]), "groups")
    over = order.select(
        F.lit("").alias("tree"),
        F.col("at").alias("place"),
        F.lit(order.count()).cast("long").alias("total"),
        F.col("at").alias("id"),
        "leaf",
        F.lit(None).cast("binary").alias("changed"),
    )
    upper = _reduced(over)
    top = upper[-1].select(F.lower(F.hex("top")).alias("root")).first()
    root = top["root"] if top else ""
    above = upper[-1].select("tree", "block", F.expr(f"CAST(array() AS {_PATH.split(' ', 1)[1]})").alias("path"), F.lit("").alias("subroot"))
    for blocks in reversed(upper):
        above = _handed_down(blocks, above)
    paths = order.join(above.select(F.col("block").alias("at"), "path"), "at")
    above = paths.select("tree", F.lit(0).cast("long").alias("block"), "path", F.lower(F.hex("leaf")).alias("subroot"))
    for blocks in reversed(rounds[1:]):
        above = materialize(_handed_down(blocks, above), "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield _proofs(row, root)

    bottom = rounds[0].select("tree", "block", "levels", "ids", "leaves", "changed").join(above, ["tree", "block"])
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return bottom.mapInArrow(run, schema)


def _proofs(row: dict, root: str) -> pa.RecordBatch:
    """The rows of one block. Leaves of a run share the siblings above it, and equal nodes fold to equal roots."""
    leaves = _split(row["leaves"])
    block = Block(leaves, row["levels"])
    upper = [(p["at"], _split(p["run"])) for p in row["path"]]
    proofs, folded = [], []
    known: dict[tuple[int, int, str], str] = {}

    def folds(level: int, slot: int, node: str) -> str:
        """The root that ``node`` at a place of the block gives."""
        key = (level, slot // WIDTH**level, node)
        if key not in known:
            if level == len(block.rows) - 1:
                known[key] = fold(node, upper)
            else:
                at, run = block.runs(slot, level)[0]
                known[key] = folds(level + 1, slot, digest([*run[:at], node, *run[at + 1 :]]))
        return known[key]

    shared = ""
    for slot, (leaf, changed) in enumerate(zip(leaves, row["changed"])):
        runs = block.runs(slot) if slot % WIDTH == 0 else None
        if runs is not None:
            shared = "".join(others(runs[1:]) + others(upper))
        first = slot - slot % WIDTH
        own = [d for i, d in enumerate(leaves[first : first + WIDTH], first) if i != slot] if row["levels"] else []
        proofs.append(digest([*own, shared]))
        folded.append(folds(0, slot, changed.hex() if changed is not None else leaf))
    n = len(leaves)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(row["ids"], pa.int64()),
            "leaf": leaves,
            "subroot": [row["subroot"]] * n,
            "root": [root] * n,
            "proof_sha256": proofs,
            "folded_root": folded,
            "verified": [f == root for f in folded],
        }
    )


def documents_manifest(docs: DataFrame, every: int = 3) -> DataFrame:
    """``manifest`` of ``docs(doc_id, source, lang, n_chars, text)``, a tree for each ``lang``.

    Rows whose ``crc32`` of the decimal ``doc_id`` ``every`` divides are tampered with: A-Z in their text are lower-cased. So a
    proof fails just where such a text has a capital. Nulls stay, rows without ``doc_id`` are not tampered with and come
    first, repeated rows each have a leaf, an empty table gives an empty result, and other columns are not read. A very long text
    is digested where it is read; only digests are shuffled.
    """
    values = [F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % every == 0
    text = F.translate("text", _UPPER, _LOWER)
    return manifest(
        docs.select(
            F.col("lang").cast("string").alias("tree"),
            F.col("doc_id").alias("id"),
            F.unhex(leaf_digest(values)).alias("leaf"),
            F.when(tampered, F.unhex(leaf_digest([*values[:-1], text]))).alias("changed"),
        )
    )
