import random
import re

import numpy as np
import pytest

from tallyworks.llm import nearduplicates as nd
from tallyworks.llm.words import WordHashes, shingle_hashes

from .conftest import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, width):
    """Set size and smallest linked id of each text, by all pairs."""
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        whole = {tuple(words)} if words else set()
        sets[i] = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} if len(words) >= width else whole
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, rng.choice(words))
    return words


def family(rng, size, words, most):
    base = [f"w{rng.randrange(300)}" for _ in range(words)]
    return [" ".join(changed(rng, base, rng.randrange(most))) for _ in range(size)]


@pytest.mark.parametrize("width", [2, 5])
def test_components_against_brute_force(docs_of, width):
    rng = random.Random(width)
    texts = list(ODD_TEXTS)
    texts += family(rng, 60, 80, 14) + family(rng, 25, 30, 5) + family(rng, 12, 300, 40)
    texts += [texts[-1].upper()] * 5 + [" ".join(f"w{rng.randrange(300)}" for _ in range(40)) for _ in range(30)]
    rng.shuffle(texts)
    want = brute(dict(enumerate(texts)), width)
    rows = nd.near_duplicates(docs_of(texts, component_id=-1, rep="x"), width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_many_near_copies_in_small_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_SETS", 8)
    texts = family(random.Random(9), 120, 60, 14)
    rows = nd.near_duplicates(docs_of(texts), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(dict(enumerate(texts)), 2)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 1200).astype(np.uint64)
    one, two = nd.signature(np.sort(values[:1000]), 4096), nd.signature(np.sort(values[200:]), 4096)
    assert abs(np.mean(one == two) - 800 / 1200) < 0.04


def test_joining_links_span_what_links():
    sets = [np.arange(a, a + 20) for a in (0, 1, 2, 50, 51, 90)]
    every = np.arange(6)
    found = nd.joining_links(every, every, sets, every, every, 80)
    assert len(found) == 3 and {frozenset(x) for x in found} <= {frozenset(x) for x in [(0, 1), (1, 2), (0, 2), (3, 4)]}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    found = {r.node: r.component for r in nd.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 150)}


def test_shorter_texts_are_one_shingle():
    hashes = WordHashes()
    assert len(shingle_hashes([b"a"], 2, hashes)) == 1
    assert shingle_hashes([b"a"], 2, hashes)[0] not in shingle_hashes([b"a", b"a", b"b"], 2, hashes)
    assert len(shingle_hashes([], 2, hashes)) == 0


def test_representatives(spark, docs_of):
    text = " ".join(f"word{i}" for i in range(50))
    docs = docs_of([text, "else", text + " more", None, None, text])
    docs = docs.unionByName(docs.where("doc_id = 1")).unionByName(docs.where("doc_id = 0").selectExpr("CAST(NULL AS LONG) doc_id", "text", "lang", "source", "n_chars"))
    kept = nd.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [0, 1, 3, 4, None]


def test_null_ids_and_repeated_rows(docs_of):
    docs = docs_of(["a b c", "a b c"])
    docs = docs.unionByName(docs).unionByName(docs.selectExpr("CAST(NULL AS LONG) doc_id", "text", "lang", "source", "n_chars"))
    rows = nd.near_duplicates(docs, 2).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == (
        [("0", "0", True)] * 2 + [("1", "0", False)] * 2 + [("None", "None", True)] * 2
    )


def test_empty_table(docs_of):
    assert nd.near_duplicates(docs_of([])).collect() == []


def test_an_id_with_several_texts_is_linked_by_each(docs_of):
    rng = random.Random(5)
    one, two, three = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(5, one), (5, two), (2, one + " end"), (9, two + " end"), (7, three), (7, three), (8, three), (4, None), (4, one)]
    docs = docs_of([]).sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for _ in range(2):
        got = {(r.doc_id, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect() if r.n_shingles}
        assert got == {(5, 2, False), (2, 2, True), (9, 2, False), (7, 7, True), (8, 7, False), (4, 2, False)}
    assert sorted(r.doc_id for r in nd.representatives(docs).collect()) == [2, 7]
