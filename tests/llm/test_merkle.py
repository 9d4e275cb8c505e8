import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyworks.llm import merkle

from .conftest import ODD_TEXTS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    said = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(said))


def grown(leaves):
    """All levels of a tree, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        first = at - at % 8
        out.append((at % 8, nodes[first : first + 8]))
        at //= 8
    return out


def by_brute_force(rows):
    """Sorted result rows of ``(doc_id, text, lang, source, n_chars)``."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: x[:3])
    built = {name: grown([x[2] for x in trees[name]]) for name in names}
    upper = grown([built[name][-1][0] for name in names])
    root = upper[-1][0]
    out = []
    for g, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(trees[name]):
            doc_id, text, *rest = row
            runs = siblings(built[name], at) + siblings(upper, g)
            proof = sha("".join(d for own, run in runs for i, d in enumerate(run) if i != own))
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                low = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
                node = leaf_of(doc_id, low, *rest)
            for own, run in runs:
                node = sha("".join([*run[:own], node, *run[own + 1 :]]))
            out.append((doc_id, leaf, built[name][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def compare(spark, rows, **extra):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name, value in extra.items():
        docs = docs.withColumn(name, F.lit(value))
    got = merkle.documents_manifest(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == by_brute_force(rows)


def corpus(n, langs, seed=4):
    rng = random.Random(seed)
    ids = rng.sample(range(-5000, 100_000), n)
    return [(i, f"Text {i}" if i % 5 else f"small {i}", rng.choice(langs), f"s{i % 3}" if i % 4 else None, i % 100) for i in ids]


def test_against_brute_force(spark):
    rows = corpus(1500, ["en"] * 6 + ["de", "fr", None, "é", "Z", "", "a", "b", "c", "d"])
    compare(spark, rows + [(10**15, "Far", "en", None, 1), (-(10**15), None, "only", None, None)], tree="x", place=1, path=2, root=3)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_tree_of_any_size(spark, n):
    compare(spark, corpus(n, ["en"]))


def test_blocks_and_directory_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "FEW_ENTRIES", 2)
    rows = corpus(700, ["en", "en", "en", None, *"abcdefghij"])
    compare(spark, rows + [((1 << 62) + i, "High", "en", "s", 0) for i in (0, 1, 64)])


def test_odd_texts_repeated_rows_and_null_ids(spark):
    rows = [(i, t, "en", None, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "Again", "en", "s", 1)] * 30 + [(3, "other", "en", "s", 1), (4, "Again", "en", "s", 1)]
    rows += [(None, "No id", "en", "s", 1)] * 5 + [(None, None, None, None, None)] * 3 + [(0, "x", None, None, None)]
    compare(spark, rows)


def test_empty_table(docs_of):
    assert merkle.documents_manifest(docs_of([])).collect() == []
