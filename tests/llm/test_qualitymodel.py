import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyworks.llm import qualitymodel as qm

from .conftest import ODD_TEXTS


def sample(n, seed=1):
    rng = random.Random(seed)
    syllables = "an er in th re on st al en ti or ou he ar es".split()

    def word():
        return "".join(rng.choices(syllables, k=rng.randint(1, 3)))

    texts, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        words = [word() for _ in range(rng.randint(20, 80))]
        if not good:
            words = rng.choice([[w.upper() + "!!" for w in words], [w + "***" for w in words], [w for w in words[:8] for _ in range(10)]])
        texts.append(" ".join(words))
        labels.append(int(good))
    return texts, labels


def labels_of(spark, labels):
    return spark.createDataFrame([(i, x, 0) for i, x in enumerate(labels)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs_of):
    texts, labels = sample(500)
    docs = docs_of(texts, score="x", predicted=3)
    model = qm.fit(docs, labels_of(spark, labels))
    rows = qm.score_documents(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in rows if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.97
    kept = qm.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_labels_of_held_out_rows_have_no_effect(spark, docs_of):
    texts, labels = sample(120)
    docs = docs_of(texts)
    turned = [1 - x if zlib.crc32(str(i).encode()) % 3 == 1 else x for i, x in enumerate(labels)]
    one, two = qm.fit(docs, labels_of(spark, labels)), qm.fit(docs, labels_of(spark, turned))
    assert np.array_equal(one.vectors, two.vectors) and np.array_equal(one.output, two.output)


def test_fast_scores_equal_the_averaged_vectors(docs_of):
    texts, labels = sample(60)
    bags = np.stack([qm.bag(t.encode(), qm.BUCKETS) for t in texts])
    model = qm.train(bags, np.array(labels))
    rows = qm.score_documents(docs_of(texts), model).collect()
    for r in rows:
        z = bags[r.doc_id] @ model.vectors @ model.output + model.bias
        p = np.exp(z - z.max())
        assert abs(r.score - p[1] / p.sum()) < 1e-4


def test_ngrams_are_of_characters():
    """Equal n-grams of any words share a bucket, others have their own; counted with plain string slices."""
    words = ["жук", "жуки", "a", "naïve", "日本語", "😀x", "ab", "ba"]
    owners, found = qm.features([w.encode() for w in words], 1 << 40)
    buckets = {}
    for i, w in enumerate(words):
        marked = f"<{w}>"
        grams = [(marked[at : at + n], n) for n in qm.GRAMS for at in range(len(marked) - n + 1)] + [(w, 0)]
        own = found[owners == i]
        assert len(own) == len(grams)
        order = [b for n in (*qm.GRAMS, 0) for b in own[[k for k, g in enumerate(grams) if g[1] == n]]]
        for gram, b in zip(grams, order):
            assert buckets.setdefault(gram, b) == b
    assert len(set(buckets.values())) == len(buckets)


def test_repeated_and_null_ids(spark, docs_of):
    texts, labels = sample(60)
    docs = docs_of(texts)
    model = qm.fit(docs, labels_of(spark, labels))
    again = qm.fit(docs.unionByName(docs), labels_of(spark, labels).unionByName(labels_of(spark, labels)))
    assert np.array_equal(model.vectors, again.vectors)
    other = docs.withColumn("text", F.lit("another text of the same id"))
    one, two = (qm.fit(x.unionByName(y), labels_of(spark, labels)) for x, y in ((docs, other), (other, docs)))
    assert np.array_equal(one.vectors, two.vectors)
    nameless = docs.withColumn("doc_id", F.expr("IF(doc_id % 2 = 0, NULL, doc_id)"))
    rows = qm.score_documents(nameless.unionByName(nameless), model).collect()
    assert len(rows) == 120 and sum(r.doc_id is None and not r.held_out for r in rows) == 60


def test_odd_texts_and_no_labels(spark, docs_of):
    texts, labels = sample(60)
    model = qm.fit(docs_of(texts), labels_of(spark, labels))
    rows = qm.score_documents(docs_of(ODD_TEXTS), model).collect()
    assert len(rows) == len(ODD_TEXTS) and all(np.isfinite(r.score) for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[0] == scores[1] == scores[2] and scores[4] == scores[5]
    none = qm.fit(docs_of(texts), labels_of(spark, labels).where("doc_id < 0"))
    assert none is None
    assert {(r.score, r.predicted) for r in qm.score_documents(docs_of(["a"]), None).collect()} == {(0.5, 1)}
    assert qm.score_documents(docs_of([]), model).collect() == []
