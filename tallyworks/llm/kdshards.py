"""Sharding by a k-d tree over document metadata.

Each node of the tree is cut at the weighted median of its widest dimension, so
that both sides hold bytes in proportion to their leaves, until every leaf is a
shard. Medians are found by histograms that Spark sums over all rows; the driver
sees one row for each node. A dimension's key has the value in its upper half and a
hash of the document and its row in the lower half: rows of equal value, were they a third of
all rows or copies of one row, can be cut anywhere.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import materialize

ROW_OVERHEAD = 16
DIMENSIONS = ("source", "lang", "size", "doc_id")

# Bins of a histogram round; a round narrows a cut down by this factor.
BINS = 1 << 14
# A cut is good enough when it is off by no more than this share of a shard.
TOLERANCE = 0.0005
# Rows of a shard that are numbered in one task.
ROWS_PER_CHUNK = 50_000

_HALF = 1 << 31


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, hash`` and the values of the dimensions from 0 to 2^31-1.

    ``hash`` differs between repeated rows too; it holds once the rows are stored.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + ROW_OVERHEAD

    def code(name: str) -> Column:
        return F.coalesce(F.shiftright(F.crc32(F.col(name).cast("string")), 1), F.lit(0))

    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", F.crc32(text), F.monotonically_increasing_id()), F.lit(1 << 32)).alias("hash"),
        code("source").alias("v_source"),
        code("lang").alias("v_lang"),
        F.least(size, F.lit(_HALF - 1)).alias("v_size"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("v_doc_id"),
    )


def _constant(values: list, kind: str) -> Column:
    """A nested list as one constant, however many numbers it has."""
    return F.from_json(F.lit(json.dumps(values)), kind)


class Tree:
    """Cuts by level. The node at place p of a level has its parts at places 2p and 2p+1 of the next."""

    def __init__(self, shards: int):
        self.leaves = {0: (0, shards)}  # place in the lowest level -> first shard, number of shards
        self.levels: list[list[list[int]]] = []  # dimensions (0: not cut) and cuts, by place

    def node(self, keys: Column) -> Column:
        """The place of a row in the lowest level; ``keys`` is the array of its dimension keys."""
        top: Column = F.lit(0)
        if not self.levels:
            return top

        def down(at: Column, level: Column) -> Column:
            dim = F.get(F.get(level, 0), at).cast("int")
            over = (dim > 0) & (F.get(keys, dim - 1) > F.get(F.get(level, 1), at))
            return at * 2 + F.when(over, 1).otherwise(0)

        return F.aggregate(_constant(self.levels, "array<array<array<bigint>>>"), top, down)

    def shard(self, keys: Column) -> Column:
        """The shard of a row, once each leaf is one."""
        firsts = [self.leaves.get(place, (None, 0))[0] for place in range(1 << len(self.levels))]
        return F.get(_constant(firsts, "array<int>"), self.node(keys))

    def cut(self, cuts: dict[int, tuple[int, int]]) -> None:
        """Add a level: dimension and cut of each place that has some; other nodes of several shards have no rows on the right."""
        places = range(1 << len(self.levels))
        self.levels.append([[cuts.get(place, (0, 0))[i] for place in places] for i in (0, 1)])
        parts = {}
        for place, (first, n) in self.leaves.items():
            parts[2 * place] = (first, max(1, n // 2))
            if n > 1:
                parts[2 * place + 1] = (first + n // 2, n - n // 2)
        self.leaves = parts


def _weighted_cuts(rows: DataFrame, wanted: dict[int, dict], leaf_bytes: float) -> None:
    """Find ``cut`` of each wanted node: keys up to it hold about ``target`` bytes."""
    open_nodes = dict(wanted)
    while open_nodes:
        places = range(max(open_nodes) + 1)
        asked_of = [[w[x] for x in ("dim", "low", "high", "width")] if (w := open_nodes.get(n)) else None for n in places]
        targets = [w["target"] - w["below"] if (w := open_nodes.get(n)) else None for n in places]
        spec = F.get(_constant(asked_of, "array<array<bigint>>"), F.col("node"))
        target = F.get(_constant(targets, "array<double>"), F.col("node"))
        asked = (
            rows.withColumn("spec", spec)
            .where(F.col("spec").isNotNull())
            .select("node", "size", "spec", F.get("keys", F.get("spec", 0).cast("int") - 1).alias("key"))
            .where(F.col("key").between(F.get("spec", 1), F.get("spec", 2)))
        )
        sums = asked.groupBy("node", F.expr("(key - spec[1]) div spec[3]").alias("bin")).agg(
            F.sum("size").alias("bytes")
        )
        upto = Window.partitionBy("node").orderBy("bin")
        crossing = (
            sums.withColumn("upto", F.sum("bytes").over(upto))
            .where(F.col("upto") >= target)
            .groupBy("node")
            .agg(F.min_by(F.struct("bin", "upto", "bytes"), "bin").alias("at"))
            .collect()
        )
        found = {r["node"]: r["at"] for r in crossing}
        for n, w in list(open_nodes.items()):
            at = found.get(n)
            if at is None:  # the target lies at the very end
                w["cut"] = w["high"]
                del open_nodes[n]
                continue
            before = w["below"] + at["upto"] - at["bytes"]
            low = w["low"] + at["bin"] * w["width"]
            high = min(w["high"], low + w["width"] - 1)
            if at["bytes"] <= TOLERANCE * leaf_bytes or low == high:
                nearer_before = w["target"] - before < before + at["bytes"] - w["target"]
                w["cut"] = low - 1 if nearer_before else high
                del open_nodes[n]
            else:
                w |= {"below": before, "low": low, "high": high, "width": max(1, -(-(high - low + 1) // BINS))}


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of each row of ``docs``.

    The law is ``bytes``: the shards' sums of ``size`` (UTF-8 bytes of the text
    and 16) are near equal, off by a document or so. ``slot`` numbers the rows of
    a shard from 0; ``grown_shard`` is null. Null texts count as empty, null metadata as one more
    value, repeated rows each get a slot and are dealt out like others, a very long text
    makes its shard as much too large, and other columns are not read. With
    fewer documents than shards some shards stay empty; an empty table gives an
    empty result. The tree's cuts travel in the plan as one constant with two numbers for each node.
    """
    stored = materialize(metadata(docs), "shard-metadata")
    whole = stored.agg(
        F.sum("size").alias("bytes"),
        F.count("*").alias("rows"),
        F.min("v_doc_id").alias("low"),
        F.max("v_doc_id").alias("high"),
    ).first()
    total, n_rows = whole["bytes"] or 0, whole["rows"]
    span = max(1, (whole["high"] or 0) - (whole["low"] or 0))
    scaled = ((F.col("v_doc_id") - F.lit(whole["low"] or 0)) / F.lit(span) * (_HALF - 1)).cast("long")
    values = [F.col("v_source"), F.col("v_lang"), F.col("v_size"), scaled]
    keyed = stored.select(
        "doc_id",
        "size",
        "text_crc32",
        "hash",
        F.array(*[v * F.lit(1 << 32) + F.col("hash") for v in values]).alias("keys"),
    )
    tree = Tree(shards)
    leaf_bytes = total / shards
    scale: list[int] | None = None
    while total and any(k > 1 for _, k in tree.leaves.values()):
        rows = keyed.withColumn("node", tree.node(F.col("keys")))
        ends = [f(F.get("keys", i)).alias(f"{f.__name__}{i}") for i in range(len(values)) for f in (F.min, F.max)]
        nodes = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()}
        wanted: dict[int, dict] = {}
        for n, (_, k) in tree.leaves.items():
            if k == 1 or n not in nodes:
                continue
            r = nodes[n]
            widths = [(r[f"max{i}"] >> 32) - (r[f"min{i}"] >> 32) for i in range(len(values))]
            scale = scale or [max(1, w) for w in widths]
            dim = max(range(len(values)), key=lambda i: (widths[i] / scale[i], -i))
            low, high = r[f"min{dim}"], r[f"max{dim}"]
            wanted[n] = {
                "dim": dim + 1,
                "low": low,
                "high": high,
                "width": max(1, -(-(high - low + 1) // BINS)),
                "target": r["bytes"] * (k // 2) / k,
                "below": 0,
            }
        _weighted_cuts(rows, wanted, leaf_bytes)
        tree.cut({n: (w["dim"], w["cut"]) for n, w in wanted.items()})

    chunks = max(1, -(-n_rows // shards // ROWS_PER_CHUNK) * 4)
    placed = keyed.select(
        "doc_id",
        "size",
        "text_crc32",
        tree.shard(F.col("keys")).alias("shard"),
        F.pmod("hash", F.lit(chunks)).cast("int").alias("chunk"),
    )
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "chunk")
        .agg(F.count("*").alias("n"))
        .select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("place", F.row_number().over(inside))
        .join(starts, ["shard", "chunk"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
