import random
import re
import struct
import zlib

import pytest
from tokenizers import Tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tallyworks.llm.queries import tokenizer_path  # noqa: E402

SECRET = "password=0123456789abcdef0123"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, near copies, junk, repetition, secrets, and odd rows; with labels."""
    rng = random.Random(6)

    def prose(n):
        return " ".join("".join(rng.choices("an er in th re on st al en ti or ou".split(), k=rng.randint(1, 3))) for _ in range(n))

    texts = [prose(rng.randint(60, 120)) for _ in range(150)]
    texts += [t + " and more" for t in texts[:20]]
    texts += [" ".join(w.upper() + "!!" for w in prose(70).split()) for _ in range(60)]
    block = prose(60)
    texts += [f"{block} {block}", "short", None, "", f"{prose(80)} {SECRET} {prose(20)}"]
    rows = [(i, t, "en", "src0", len(t or ""), i % 2) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _clean int").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 170), 0) for i in range(230) if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, texts


def test_stages(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, path)
        assert after.columns == docs.columns, name
        rows = {r.doc_id: r for r in after.collect()}
        ids.append(set(rows))
        docs = spark.createDataFrame(list(rows.values()), docs.schema)
    n = len(texts)
    assert ids[0] == set(range(n)) - {n - 5, n - 4, n - 3, n - 2}  # repetition, short, null, empty
    assert ids[1] == ids[0] - set(range(170, 230))  # junk
    assert ids[2] == ids[1] - set(range(150, 170))  # near copies
    assert ids[3] == ids[2]
    assert rows[n - 1].text == texts[-1].replace(SECRET, "[removed]") and rows[n - 1].n_chars == len(rows[n - 1].text)
    assert all(rows[i].text == texts[i] for i in range(150))
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    lengths = {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows.items()}
    assert {r.doc_id: r.length for r in pieces} == lengths
    whole = corpus_pipeline.run(spark, path)
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, pieces))


def test_packed_pieces_carry_their_ids(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    for r in rows:
        assert r.ids == [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "secret_scan", "best_fit_packing"]
    assert re.search("def run", open(corpus_pipeline.__file__).read())
