"""Secrets in texts: fixed shapes, and tokens that a battery of randomness tests takes for random.

All of it is column expressions: each text is read where it lies. The only numbers
gathered are counts of tokens by strength of evidence, from which the limit for
discoveries is set.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import free_name

# Fixed patterns of the base kinds, in their order, and what a match needs.
ASSIGN = r"""(?iu:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a run that long or longer: shorter ones can't hold a longer one
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

# Tokens that the battery looks at: 12 characters or more, but no plain words, small letters with a first one of
# either case. A word of up to 20 letters can't reach an evidence of 2, the least limit there is for discoveries.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?![A-Za-z][a-z]{11,19}(?![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_-]{12,}+={0,2}"

# Alphabets by inferred encoding, the narrowest first.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    (r"^[0-9]+$", _DIGITS),
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^[a-z]+$", _LOWER),
    (r"^[A-Z2-7]+$", _UPPER + "234567"),
    (r"^[a-z0-9]+$", _DIGITS + _LOWER),
    (r"^[A-Z0-9]+$", _DIGITS + _UPPER),
    (r"^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    (r"", _DIGITS + _UPPER + _LOWER + "+/-_"),
)

# A random token passes the battery with this probability of error.
BATTERY_LEVEL = 0.001
# Share of false discoveries among the random tokens reported.
FALSE_DISCOVERIES = 0.01

# What ordinary text looks like: how often two of a token's letters are equal, and how often
# neighbouring letters change between digits, capitals and small letters.
TEXT_COLLISIONS, TEXT_CHANGES, TEXT_SPREAD = 0.066, 0.12, 1.5

# Evidence is counted in steps of a tenth of a decimal power, up to this many.
STEPS, STEP = 4000, 0.1

_SPAN = "array<struct<start: int, ord: int, end: int, value: string>>"

# Code points of a text that are looked through to cut a piece out.
_CHUNK = 4096


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join``, which is associative and starts from 0, makes of each value and all before it.

    Done in blocks of about the root of the number of values, and then over blocks, so that no long array is copied
    for each of its elements.
    """

    def blocks(all_values: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_values))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(all_values), size), lambda at: block(F.slice(all_values, at, size)))

    def start(kind: str) -> Column:
        return F.struct(F.lit(0).alias("last"), F.array().cast(kind).alias("made"))

    def block(some: Column) -> Column:
        def step(acc: Column, value: Column) -> Column:
            last = join(acc["last"], value)
            return F.struct(last.alias("last"), F.concat(acc["made"], F.array(last)).alias("made"))

        return F.aggregate(some, start("array<int>"), step)

    def together(parts: Column) -> Column:
        def step(acc: Column, part: Column) -> Column:
            moved = F.transform(part["made"], lambda value: join(acc["last"], value))
            return F.struct(join(acc["last"], part["last"]).alias("last"), F.concat(acc["made"], F.array(moved)).alias("made"))

        return F.aggregate(parts, start("array<array<int>>"), step, lambda acc: F.flatten(acc["made"]))

    found = _with(values, lambda all_values: _with(blocks(all_values), together))
    return F.when(F.size(values) > 0, found).otherwise(F.array().cast("array<int>"))


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches, by code points, with the matched texts."""

    def placed(both: Column) -> Column:
        gaps = F.slice(both["gaps"], F.lit(1), F.size(both["found"]))
        ends = _running(F.zip_with(gaps, both["found"], lambda gap, match: F.length(gap) + F.length(match)), lambda a, b: a + b)
        return F.zip_with(
            ends,
            both["found"],
            lambda end, match: F.struct((end - F.length(match)).alias("start"), F.lit(kind).alias("ord"), end.alias("end"), match.alias("value")),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    split = F.struct(F.split(text, pattern, -1).alias("gaps"), found.alias("found"))
    return F.when(F.rlike(text, F.lit(pattern)), _with(split, placed)).otherwise(F.array().cast(_SPAN))


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to before ``end``, in code points, from its ``_chunks``; only those in reach are looked through."""
    first = F.floor(start / _CHUNK).cast("int")
    reached = F.slice(chunks, first + 1, F.floor(end / _CHUNK).cast("int") - first + 1)

    def part(chunk: Column, at: Column) -> Column:
        before = (first + at) * _CHUNK
        begin = F.greatest(start - before, F.lit(0))
        return F.substring(chunk, begin + 1, F.least(end - before, F.lit(_CHUNK)) - begin)

    return F.array_join(F.transform(reached, part), "")


def base_spans(text: Column) -> Column:
    """Spans of the three fixed shapes."""
    assigned = F.filter(_matches(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    access = F.when(F.contains(text, F.lit("AKIA")), _matches(text, ACCESS, 1)).otherwise(F.array().cast(_SPAN))
    return F.concat(assigned, access, _matches(text, HEX, 2))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, close enough over all z."""
    above = F.exp(-0.717 * F.abs(z) - 0.416 * z * z) / 2
    return F.greatest(F.when(z > 0, above).otherwise(1 - above), F.lit(1e-300))


def evidence(token: Column) -> Column:
    """-log10 of the probability that text makes a token look so random; 0 if it isn't random anyway.

    The encoding is the narrowest alphabet that holds the token. Within it three tests
    ask whether the token is random: chi-squared for uniform use of the alphabet,
    the number of runs above and below its middle, and the correlation of neighbours.
    Their probabilities are joined by Fisher's method. A token that passes is held against
    text: equal letters would be more frequent there, changes between
    digits, capitals and small letters rarer. Both get stronger with length. A token is gone through
    twice, in its own order and by letter, with a handful of sums.
    """
    plain = F.regexp_replace(token, "=", "")
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(F.rlike(plain, F.lit(pattern)), F.lit(letters)).otherwise(alphabet)

    def classes(x: Column) -> Column:
        only = F.regexp_replace(x, "[^A-Za-z0-9]", "")
        kinds = F.translate(only, _DIGITS + _UPPER + _LOWER, "0" * 10 + "1" * 26 + "2" * 26)
        runs = F.length(F.regexp_replace(kinds, r"(.)\1*", "r"))
        return F.struct(F.length(only).cast("double").alias("letters"), runs.cast("double").alias("runs"))

    def zeros(*names: str) -> Column:
        return F.struct(*[F.lit(0.0).alias(name) for name in names])

    def tested(t: Column) -> Column:
        def in_order(acc: Column, x: Column) -> Column:
            high = F.when(x > t["k"] / 2, F.lit(1.0)).otherwise(F.lit(0.0))
            begun = acc["n"] > 0
            return F.struct(
                (acc["n"] + 1).alias("n"),
                (acc["sum"] + x).alias("sum"),
                (acc["square"] + x * x).alias("square"),
                (acc["high"] + high).alias("high"),
                F.when(begun, acc["product"] + acc["last"] * x).otherwise(F.lit(0.0)).alias("product"),
                F.when(begun & (acc["was_high"] != high), acc["changes"] + 1).otherwise(acc["changes"]).alias("changes"),
                F.when(begun, acc["first"]).otherwise(x).alias("first"),
                x.alias("last"),
                high.alias("was_high"),
            )

        def by_letter(acc: Column, x: Column) -> Column:
            run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1.0))  # squares grow by odd numbers
            return F.struct((acc["squares"] + 2 * run - 1).alias("squares"), run.alias("run"), x.alias("last"))

        start = zeros("n", "sum", "square", "high", "product", "changes", "first", "last", "was_high")
        letters = F.aggregate(F.array_sort(t["ids"]), zeros("squares", "run", "last"), by_letter, lambda acc: acc["squares"])
        both = F.struct(F.aggregate(t["ids"], start, in_order).alias("o"), letters.alias("squares"), t["k"].alias("k"), t["c"].alias("c"))
        return _with(both, summed)

    def summed(b: Column) -> Column:
        o = b["o"]
        mean = o["sum"] / o["n"]
        # the sums of products of centred neighbours and of centred squares
        product = o["product"] - mean * (2 * o["sum"] - o["first"] - o["last"]) + (o["n"] - 1) * mean * mean
        sums = F.struct(
            o["n"].alias("n"), b["squares"].alias("squares"), o["high"].alias("high"), o["changes"].alias("changes"),
            product.alias("product"), (o["square"] - o["sum"] * mean).alias("variance"), b["k"].alias("k"), b["c"].alias("c"),
        )
        return _with(sums, lambda m: _with(joined_tests(m), lambda log_p: compared(m, log_p)))

    def joined_tests(m: Column) -> Column:
        """The logarithm of the product of the three probabilities."""
        n, k = m["n"], m["k"]
        chi = (m["squares"] * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        both = 2 * m["high"] * (n - m["high"])
        spread = both * (both - n) / (n * n * (n - 1))
        runs = F.when(spread > 0, (m["changes"] - both / n) / F.sqrt(spread)).otherwise(F.lit(9.0))
        serial = F.when(m["variance"] > 1e-6, (m["product"] / m["variance"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
        return F.log(_tail(chi)) + F.log(2 * _tail(F.abs(runs))) + F.log(2 * _tail(F.abs(serial)))

    def compared(m: Column, log_p: Column) -> Column:
        n = m["n"]
        random = F.exp(log_p) * (1 - log_p + log_p * log_p / 2)  # chi-squared tail with 6 degrees of freedom
        expected = n * (n - 1) / 2 * TEXT_COLLISIONS
        distance = (expected - (m["squares"] - n) / 2) / (TEXT_SPREAD * F.sqrt(expected * (1 - TEXT_COLLISIONS)))
        by_letters = F.when(distance > 0, -F.log10(_tail(distance))).otherwise(F.lit(0.0))
        places = F.greatest(m["c"]["letters"] - 1, F.lit(1.0))
        share = F.least((m["c"]["runs"] - 1) / places, F.lit(1 - 1e-9))
        divergence = share * F.log(share / TEXT_CHANGES) + (1 - share) * F.log((1 - share) / (1 - TEXT_CHANGES))
        by_changes = F.when(share > TEXT_CHANGES, places * divergence / math.log(10)).otherwise(F.lit(0.0))
        strength = F.greatest(by_letters, by_changes) - math.log10(2)
        return F.when(random >= BATTERY_LEVEL, F.greatest(strength, F.lit(0.0))).otherwise(F.lit(0.0))

    def prepared(a: Column) -> Column:
        ids = F.transform(F.split(a["plain"], ""), lambda c: F.instr(a["alphabet"], c).cast("double"))
        given = F.struct(
            F.filter(ids, lambda x: x > 0).alias("ids"), F.length(a["alphabet"]).cast("double").alias("k"), classes(a["plain"]).alias("c")
        )
        return _with(given, tested)

    return _with(F.struct(plain.alias("plain"), alphabet.alias("alphabet")), prepared)


def discovery_limit(docs: DataFrame, share: float = FALSE_DISCOVERIES) -> float:
    """The least evidence to report, by Benjamini and Hochberg over all tokens of ``docs``.

    Of all tokens with at least that evidence, no more than ``share`` are expected
    to be text: where ``above`` of ``total`` tokens are reported, the limit is ``-log10(share * above / total)``. More
    tokens of text raise it, more secrets lower it, to 2 at least for a ``share`` of 0.01. The driver gets the number of
    tokens for each step of evidence.
    """
    text = F.coalesce("text", F.lit(""))
    tokens = docs.where(F.rlike(text, F.lit(TOKEN))).select(F.explode(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))).alias("token"))
    # Copies share a token; it is tested once for each distinct one, and counted as often as it occurs.
    counted = tokens.groupBy("token").agg(F.count("*").alias("n"))
    step = F.least(F.floor(evidence(F.col("token")) / STEP), F.lit(STEPS)).cast("int")
    counts = {r["step"]: r["n"] for r in counted.groupBy(step.alias("step")).agg(F.sum("n").alias("n")).collect()}
    total, above, limit = sum(counts.values()), 0, math.inf
    for at in sorted(counts, reverse=True):
        above += counts[at]
        if at > 0 and 10 ** (-at * STEP) <= share * above / total:
            limit = -math.log10(share * above / total)
    return limit


def _random_spans(rest: Column, limit: float) -> Column:
    return F.filter(_matches(rest, TOKEN, 3), lambda s: evidence(s["value"]) >= limit)


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of ``spans``, so that no token lies in one and none is held against each of them."""
    return F.when(F.size(spans) > 0, _replaced(text, spans, lambda n: F.repeat(F.lit(" "), n))).otherwise(text)


def secret_spans(text: Column, limit: float) -> Column:
    """All spans of a text, by start and then kind; random ones only outside of the others."""
    return _with(
        F.array_sort(base_spans(text)),
        lambda base: F.array_sort(F.concat(base, _random_spans(_blanked(text, base), limit))),
    )


def with_spans(docs: DataFrame, limit: float, name: str) -> DataFrame:
    """``docs`` with ``secret_spans`` of their text, null counting as empty, in a column ``name``.

    Column by column, as Spark resolves deeply nested functions level by level and stops after a hundred.
    """
    base, rest = free_name(docs, "_base"), free_name(docs, "_rest")
    text = F.coalesce("text", F.lit(""))
    return (
        docs.withColumn(base, F.array_sort(base_spans(text)))
        .withColumn(rest, _blanked(text, F.col(base)))
        .withColumn(name, F.array_sort(F.concat(F.col(base), _random_spans(F.col(rest), limit))))
        .drop(base, rest)
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_secrets(docs: DataFrame, limit: float | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` of each row of ``docs(doc_id, text)``.

    Spans are ``kind:start:end`` in code points, the end exclusive. Null texts
    count as empty: no spans, and the digest of an empty string. Repeated rows and null ids stay; other
    columns are not read; an empty table gives an empty result. Without ``limit`` it is set from ``docs``.
    """
    if limit is None:
        limit = discovery_limit(docs)
    found = with_spans(docs.select("doc_id", "text"), limit, "found")

    def number(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["ord"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["ord"] < 3)
    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def _replaced(text: Column, spans: Column, filler: Callable[[Column], Column]) -> Column:
    """``text`` with a filler, made for its length, in place of each row of overlapping ``spans``, which come by start."""

    def cut(rows: Column) -> Column:
        given = F.struct(rows.alias("spans"), _running(F.transform(rows, lambda s: s["end"]), F.greatest).alias("upto"))
        return _with(given, merged)

    def merged(g: Column) -> Column:
        def apart(at: Column) -> Column:
            """Whether the span at a place begins behind all before it, which reach furthest by ``upto``."""
            return F.coalesce(F.get(g["spans"], at)["start"] >= F.get(g["upto"], at - 1), F.lit(True))

        starts = F.filter(g["spans"], lambda s, at: apart(at))
        ends = F.filter(g["upto"], lambda end, at: apart(at + 1))
        places = F.zip_with(starts, ends, lambda a, end: F.struct(a["start"].alias("start"), end.alias("end")))
        return _with(F.struct(_chunks(text).alias("chunks"), places.alias("places")), joined)

    def joined(g: Column) -> Column:
        def piece(place: Column, at: Column) -> Column:
            behind = F.coalesce(F.get(g["places"], at - 1)["end"], F.lit(0))
            return F.concat(_cut(g["chunks"], behind, place["start"]), filler(place["end"] - place["start"]))

        last = F.element_at(g["places"], -1)["end"]
        return F.concat(F.array_join(F.transform(g["places"], piece), ""), _cut(g["chunks"], last, F.length(text)))

    return _with(spans, cut)


def redacted(text: Column, limit: float, mark: str = "[removed]") -> Column:
    """``text`` with each span, or each row of overlapping spans, replaced by ``mark``."""
    return _with(secret_spans(text, limit), lambda spans: _marked(text, spans, mark))


def _marked(text: Column, spans: Column, mark: str) -> Column:
    return F.when(F.size(spans) > 0, _replaced(text, spans, lambda n: F.lit(mark))).otherwise(text)


def with_redacted(docs: DataFrame, limit: float, name: str, mark: str = "[removed]") -> DataFrame:
    """``docs`` with their ``redacted`` text in a column ``name``; null stays null."""
    spans = free_name(docs, "_spans")
    return with_spans(docs, limit, spans).withColumn(name, _marked(F.col("text"), F.col(spans), mark)).drop(spans)
