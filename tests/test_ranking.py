import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import ranking

# Trees named in walks through a park; a walk names each tree any number of times.
TREES = ["oak", "ash", "lime", "yew", "elm", "fir"]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id STRING, text STRING")


def ranked(df):
    return [tuple(r) for r in df.collect()]


def walks(seed=8, n=60):
    """Texts, and how many of them name each tree. The first trees are common, the last one never occurs."""
    rng, rows, counts = random.Random(seed), [], Counter()
    for i in range(n):
        named = [t for place, t in enumerate(TREES[:-1]) if rng.random() < 0.9 / (place + 1)]
        words = [w for t in named for w in [t] * rng.randint(1, 3)]
        words += rng.choices(["past", "oaks", "limes", "ash,", "Yew", "under"], k=rng.randint(0, 6))
        rng.shuffle(words)
        rows.append((f"walk{i}", " ".join(words)))
        counts.update(named)
    return rows, sorted(counts.items(), key=lambda tree: (-tree[1], tree[0]))


@pytest.mark.parametrize("text, n", [("oak", 1), ("an oak", 1), ("oak oak", 1), ("oaks", 0), ("oak,", 0), ("Oak", 0), ("", 0)])
def test_only_whole_words_are_mentions(spark, text, n):
    assert ranking.documents_mentioning(docs(spark, [("w", text)]), "oak").first()["n"] == n


@pytest.mark.parametrize("seed", [1, 2])
def test_all_forms_equal_a_plain_count(spark, seed):
    rows, expected = walks(seed)
    walked = docs(spark, rows)
    assert ranked(ranking.rank_terms(walked, TREES)) == expected
    assert ranked(ranking.rank_terms_one_pass(walked, TREES)) == expected
    assert ranked(ranking.rank_from_index(ranking.term_index(walked, TREES))) == expected


def test_index_by_brute_force(spark):
    rows, _ = walks()
    index = ranking.term_index(docs(spark, rows), TREES)
    assert sorted(ranked(index)) == sorted((t, i) for i, text in rows for t in TREES if t in text.split())


def test_ties_go_by_name(spark):
    rows = docs(spark, [("w1", "yew elm"), ("w2", "fir"), ("w3", "elm yew fir"), ("w4", "ash")])
    for rank in (ranking.rank_terms, ranking.rank_terms_one_pass):
        assert ranked(rank(rows, TREES)) == [("elm", 2), ("fir", 2), ("yew", 2), ("ash", 1)]


def test_terms_given_twice_or_never_named(spark):
    rows = docs(spark, walks()[0])
    for rank in (ranking.rank_terms, ranking.rank_terms_one_pass):
        assert ranked(rank(rows, ["fir", "lime", "lime"])) == [t for t in walks()[1] if t[0] == "lime"]
    with pytest.raises(ValueError):
        ranking.unique_terms([])


def test_default_terms(spark):
    rows = docs(spark, [("1", "Perl Perl C# c++"), ("2", "C# CSS-free Perl6"), ("3", "perl")])
    assert ranked(ranking.rank_terms(rows)) == [("C#", 2), ("Perl", 1)]


def test_long_posting_lists_come_in_pieces(spark):
    many = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 990, "hot").otherwise("cold").alias("text"),
    )
    index = ranking.term_index(many, ["hot", "cold"])
    rows = ranking.postings_by_term(index, width=100).collect()
    hot = [r for r in rows if r["term"] == "hot"]
    assert len(hot) == 10 and max(len(r["doc_ids"]) for r in hot) == 100
    assert sorted(d for r in hot for d in r["doc_ids"]) == list(range(990))
    assert [r["doc_ids"] for r in rows if r["term"] == "cold"] == [list(range(990, 1000))]


def test_no_join_with_the_terms(spark, plan_of):
    rows = docs(spark, walks()[0])
    for df in (ranking.rank_terms(rows, TREES), ranking.term_index(rows, TREES)):
        plan = plan_of(df)
        assert "Join" not in plan and "Cartesian" not in plan and "EvalPython" not in plan
