"""URL rules by a sort-merge range join.

A rule covers a host with all its subdomains, and the paths that start with its
own. With host labels reversed (``example.net`` becomes ``net.example.``) the
covered hosts are exactly the keys that start with the rule's key, which makes a
rule an interval of the sorted keys. Intervals of prefixes are nested or apart.
A sweep over the sorted keys and interval ends therefore needs no more than a
stack of the intervals that are open. ``sweep`` does that with a window per
range of keys, on sorted tables of any size. It runs twice: over hosts, and then,
for each rule host found, over paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# What a url without a rule gets.
DEFAULT_VERDICT = "allow"

# Order of events at one key: intervals end, then begin (outer ones first), then points.
_END, _BEGIN, _POINT = 0, 1, 2


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit(""))
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``m.example.net`` as ``net.example.m.``: a prefix of the keys of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def sweep(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """``points(key)`` with ``stack``: the ``intervals(key)`` that are prefixes of each key, outer first.

    Both are distinct non-null strings. Keys compare as UTF-8 bytes. The byte
    0xFF is in no UTF-8 text, so the keys with prefix p lie from p to p+FF.
    Events are sorted into ranges of keys; what is open at the start of a range is carried
    over from the ranges before it, one row for each range.
    """
    binary = F.col("key").cast("binary")
    events = (
        points.select(binary.alias("at"), F.lit(_POINT).alias("kind"), "key")
        .unionByName(intervals.select(binary.alias("at"), F.lit(_BEGIN).alias("kind"), "key"))
        .unionByName(
            intervals.select(
                F.concat(binary, F.lit(b"\xff")).alias("at"), F.lit(_END).alias("kind"), "key"
            )
        )
    )
    step = F.when(F.col("kind") == _BEGIN, 1).when(F.col("kind") == _END, -1).otherwise(0)
    # Written once: ranges drawn anew by a later job could be other ranges.
    ranged = materialize(
        events.withColumn("step", step)
        .repartitionByRange("at")
        .withColumn("part", F.spark_partition_id()),
        "sweep",
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("part")
        .agg(F.sum("step").alias("sum"))
        .select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    )
    upto = (
        Window.partitionBy("part")
        .orderBy("at", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = ranged.join(F.broadcast(offsets), "part").select(
        "part", "at", "kind", "key", (F.col("offset") + F.sum("step").over(upto)).alias("depth")
    )
    # Nested prefixes of one key: no more than it has characters, usually two or three.
    levels = placed.agg(F.max(F.when(F.col("kind") == _BEGIN, F.col("depth")))).first()[0] or 0
    if not levels:
        return points.select("key", F.array().cast("array<string>").alias("stack"))

    def begun(level: int) -> Column:
        return F.when((F.col("kind") == _BEGIN) & (F.col("depth") == level), F.col("key"))

    depths = range(1, levels + 1)
    carried = (
        placed.where(F.col("kind") == _BEGIN)
        .groupBy("part")
        .agg(*[F.max_by(begun(d), F.when(begun(d).isNotNull(), F.col("at"))).alias(f"c{d}") for d in depths])
    )
    carried = offsets.select("part").join(carried, "part", "left")
    carried = carried.select(
        "part", *[F.last(f"c{d}", ignorenulls=True).over(earlier).alias(f"c{d}") for d in depths]
    )
    open_at = F.array(
        *[F.coalesce(F.last(begun(d), ignorenulls=True).over(upto), F.col(f"c{d}")) for d in depths]
    )
    return (
        placed.join(F.broadcast(carried), "part")
        .select("kind", "key", F.slice(open_at, F.lit(1), F.col("depth").cast("int")).alias("stack"))
        .where(F.col("kind") == _POINT)
        .select("key", "stack")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """``key, host, path, rule, verdict`` of each row of ``pages``.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the
    url's path starts with the rule's. The longest rule wins, at equal length the
    one with the longer host. ``rule`` is its host and path; without one it is
    null and the verdict ``allow``. Null urls and urls without ``://`` have an
    empty host and path, which no rule fits. Repeated rows stay repeated,
    repeated rules count once (the verdict of the smallest name), rules with a null
    host or path are ignored; other columns are not read. An empty table gives an empty result.

    Shuffled are distinct hosts and distinct pairs of host and path, reduced on the
    map side. A host with many rows only meets joins that AQE can split.
    """
    rule = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.translate("host", UPPER, UPPER.lower()).alias("rule_host"),
        F.col("path").alias("rule_path"),
        "verdict",
    )
    rule = rule.groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))
    rule = rule.withColumn("rule_key", reversed_host(F.col("rule_host")))
    rows = pages.select(
        F.col(key).alias("page_id"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
    )
    places = rows.select("host", "path").distinct()
    hosts = places.select("host").distinct().withColumn("key", reversed_host(F.col("host")))
    fitting_hosts = sweep(hosts.select("key").distinct(), rule.select(F.col("rule_key").alias("key")).distinct())
    open_rules = hosts.join(fitting_hosts, "key").select("host", F.explode("stack").alias("rule_key"))

    # The same over paths; \x01 keeps rule hosts apart.
    def path_key(path: str) -> Column:
        return F.concat(F.col("rule_key"), F.lit("\x01"), F.col(path))

    asked = places.join(open_rules, "host").select("host", "path", path_key("path").alias("key"))
    ruled = rule.withColumn("innermost", path_key("rule_path"))
    fitting = sweep(asked.select("key").distinct(), ruled.select(F.col("innermost").alias("key")))
    found = (
        asked.join(fitting, "key")
        .select("host", "path", F.try_element_at("stack", F.lit(-1)).alias("innermost"))
        .join(ruled, "innermost")
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"),
                F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host")),
            ).alias("best")
        )
    )
    return rows.join(found, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )
