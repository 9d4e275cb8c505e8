import random

import numpy as np
import pytest
import sentencepiece

from tallyworks.llm import suffixpieces as sp
from tallyworks.llm.queries import PIECES, queries, tokenizer_path

from .conftest import ODD_TEXTS


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


@pytest.fixture(scope="module")
def encoder():
    return sp.TextEncoder(tokenizer_path(PIECES))


def texts(n):
    rng = random.Random(8)
    alphabet = ["the", "ing", "er", "s", ".", ",", "!", " ", "  ", "\n", "é", "日", "😀", "\t", "▁", "1", "0x", "'", "<s>", "\u0000", "Ω"]
    return ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(n)]


def test_equal_to_the_library(encoder, library):
    given = [t or "" for t in ODD_TEXTS] + texts(400) + ["a" * 300, "    code", "aaa bbb"]
    found = encoder.encode(given)
    assert found == library.encode(given)
    assert [encoder.decode(x) for x in found] == [library.decode(x) for x in found]


def test_ranges_by_brute_force(encoder):
    v = encoder.vocabulary
    text = np.array([v.code[c] for c in "▁thethe▁other"] + [0])
    suffixes = np.array(sorted(range(len(text)), key=lambda i: text[i:].tolist()))
    low, high = v.ranges(text, suffixes)
    for row, i in enumerate(v.ids.tolist()):
        want = {at for at in range(len(text)) if text[at : at + v.lengths[row]].tolist() == v.chars[row, : v.lengths[row]].tolist()}
        assert set(suffixes[low[row] : high[row]].tolist()) == want


def test_round_trip_in_spark(docs_of, library):
    given = ODD_TEXTS + texts(30)
    encoded = sp.encode_documents(docs_of(given, ids="x"), tokenizer_path(PIECES))
    rows = encoded.collect()
    assert len(rows) == len(given) and all(r.decoded_same for r in rows)
    assert all(r.ids == library.encode(given[r.doc_id] or "") and r.n_ids == len(r.ids) for r in rows)
    back = {r.doc_id: r.text for r in sp.decode_documents(encoded, tokenizer_path(PIECES)).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(given))
    assert sp.encode_documents(docs_of([]), tokenizer_path(PIECES)).collect() == []


def test_the_query_gives_ids_and_decoded_texts(spark, docs_of, library, tmp_path):
    given = ODD_TEXTS + texts(30)
    docs_of(given).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries()["op8_suffix_pieces"](spark, str(tmp_path)).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r.ids == library.encode(given[r.doc_id] or "")
        assert r.decoded == library.decode(r.ids) and r.decoded_same
