import hashlib
import random
from collections import defaultdict

from tallyworks.llm import chunkrecipes as cr

from .conftest import ODD_TEXTS

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_brute_force(texts):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[lowered(t)].append(i)
    return [(i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g]


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefÄé", k=rng.randint(1, 9))) for _ in range(n))


def texts_with_copies():
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(1, 900)) for _ in range(60)]
    texts += [texts[3].upper(), texts[5].replace("a", "A"), texts[7] + " ", texts[9][1:], texts[20], texts[20].replace("é", "É")]
    return texts + [texts[11]] * 200 + ODD_TEXTS


def test_against_brute_force(docs_of):
    texts = texts_with_copies()
    got = cr.exact_duplicates(docs_of(texts, recipe="x", row=1, group_size=2, fresh=None)).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(by_brute_force(texts))


def test_short_identifiers_are_found_out_and_replaced(docs_of):
    texts = texts_with_copies()
    docs = docs_of(texts)
    assert cr.ambiguous(cr.recipes(docs, id_bytes=1)) and not cr.ambiguous(cr.recipes(docs))
    got = cr.exact_duplicates(docs, id_bytes=1).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(by_brute_force(texts))


def test_clash_between_tasks_is_found(docs_of, spark, monkeypatch):
    monkeypatch.setattr(cr, "REMEMBERED", 0)  # a task forgets at once
    docs = docs_of(texts_with_copies()).repartition(4)
    assert cr.ambiguous(cr.recipes(docs, id_bytes=1))


def test_chunks_join_to_the_text_and_follow_the_content():
    rng = random.Random(2)
    text = prose(rng, 30_000).encode()
    whole = cr.chunks_of(text)
    assert b"".join(whole) == text and all(cr.LEAST <= len(c) <= cr.MOST for c in whole[:-1])
    moved = cr.chunks_of(b"some words in front " + text)
    assert len(set(whole) & set(moved)) > 0.9 * len(whole)
    assert [len(c) for c in cr.chunks_of(b"x" * 20_000)] == [8192, 8192, 3616]
    assert cr.chunks_of(b"") == [] and cr.chunks_of(b"ab") == [b"ab"]


def test_cuts_do_not_depend_on_how_a_long_text_is_worked_on(monkeypatch):
    text = prose(random.Random(3), 20_000).encode()
    whole = cr.cut_candidates(text).tolist()
    monkeypatch.setattr(cr, "_AT_ONCE", 997)
    assert cr.cut_candidates(text).tolist() == whole and len(whole) > 20


def test_repeated_ids_and_nulls(docs_of):
    docs = docs_of(["a", "A", "b", None]).selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    rows = cr.exact_duplicates(docs.unionByName(docs)).collect()
    assert all(r.doc_id is None and r.keep_id is None for r in rows) and sum(r.kept for r in rows) == 3
    same = docs_of(["a"]).unionByName(docs_of(["a"])).unionByName(docs_of(["b"]))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in cr.exact_duplicates(same).collect()) == [(0, 0, 1, True), (0, 0, 2, False), (0, 0, 2, True)]


def test_empty_table(docs_of):
    assert cr.exact_duplicates(docs_of([])).collect() == []
