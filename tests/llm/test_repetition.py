import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyworks.llm import repetition

from .conftest import ODD_TEXTS


def brute(text, least):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def covered(width):
        windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        seen = Counter(windows)
        return {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(width)}

    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered(3)),
        len(covered(least)),
    )


def test_longest_repeats_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        ids = [rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(1, 40))]
        _, dense = np.unique(ids, return_inverse=True)
        n = len(ids)
        want = [max([0, *(k for j in range(n) if j != i for k in range(1, n - max(i, j) + 1) if ids[i : i + k] == ids[j : j + k])]) for i in range(n)]
        assert repetition.longest_repeats(dense).tolist() == want


def test_rows_against_brute_force(docs_of):
    rng = random.Random(5)
    texts = list(ODD_TEXTS)
    for _ in range(60):
        vocabulary = ["a", "b", "c|", "dé", "e#"][: rng.randrange(1, 6)]
        texts.append(rng.choice(["", "\n"]).join(rng.choice([" ", "\n", "\t"]) + rng.choice(vocabulary) for _ in range(rng.randrange(0, 160))))
    rows = repetition.repetition_rules(docs_of(texts, kept=1)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_words)
        assert got == brute(texts[r.doc_id], repetition.LEAST_REPEAT)
        assert sum(s.end - s.start for s in r.spans) == r.covered_words
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_verdict(docs_of):
    prose = " ".join(f"word{i}" for i in range(200))
    block = " ".join(f"again{i}" for i in range(90))
    rows = repetition.repetition_rules(docs_of([prose, f"{prose} {block} middle {block}", f"{block} x {block}"])).collect()
    assert [r.kept for r in sorted(rows)] == [True, False, False]
    assert sorted(rows)[1].longest_repeat == 90


def numbered(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


# Words of the text, of a passage, and how often it stands there.
@pytest.mark.parametrize(
    ("n", "passage", "times"),
    [(1000, 200, 2), (1000, 100, 2), (1000, 10, 20), (350, 10, 10), (350, 50, 2), (200, 20, 2), (150, 10, 4), (100, 10, 3), (60, 12, 2), (5000, 500, 2)],
)
def test_repetition_that_passes_the_base_is_rejected(docs_of, n, passage, times):
    block = numbered("again", passage)
    rest = numbered("word", n - passage * times).split()
    apart = [rest[i::times] for i in range(times)]
    texts = [" ".join([block, *part]) for part in apart], [" ".join([block] * times), *rest]
    rows = repetition.repetition_rules(docs_of([" ".join(t) for t in texts])).collect()
    for r in rows:
        assert r.n_words == n and 0.2 * n <= r.covered_words <= 0.4 * n + 1
        assert not r.base_failed and not r.kept


@pytest.mark.parametrize(("n", "line"), [(64, 9), (90, 13), (130, 13), (500, 13), (5000, 13)])
def test_a_line_at_head_and_foot_is_kept(docs_of, n, line):
    block = numbered("again", line)
    (row,) = repetition.repetition_rules(docs_of([f"{block} {numbered('word', n - 2 * line)} {block}"])).collect()
    assert row.covered_words == 2 * line and row.kept


def test_a_long_run_is_rejected_by_its_longest_repeat(docs_of):
    text = f"{numbered('word', 900)} {' '.join([numbered('again', 10)] * 10)}"
    (row,) = repetition.repetition_rules(docs_of([text])).collect()
    assert (row.covered_words, row.longest_repeat, row.base_failed, row.kept) == (100, 90, False, False)


def test_passing_keeps_all_columns(docs_of):
    prose = " ".join(f"word{i}" for i in range(60))
    docs = docs_of([prose, "short", None, prose], kept="no", spans=7)
    kept = repetition.passing(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [0, 3]


@pytest.mark.parametrize("make", [repetition.repetition_rules, repetition.passing])
def test_empty_table(docs_of, make):
    assert make(docs_of([])).collect() == []
