import os

import pytest

from tallyworks import session, storage
from tallyworks.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    return tmp_path


def test_stored_tables_go_with_their_scope(spark, shared):
    outer = session.materialize(spark.range(5), "outer")
    with session.stored_tables(spark):
        assert session.materialize(spark.range(3), "inner").count() == 3
        assert len(os.listdir(shared)) == 2
    assert outer.count() == 5 and len(os.listdir(shared)) == 1
    with pytest.raises(ZeroDivisionError), session.stored_tables(spark):
        session.materialize(spark.range(3), "inner")
        1 / 0
    assert len(os.listdir(shared)) == 1
    assert session.drop_stored(spark) >= 1 and os.listdir(shared) == []


def test_persisted_rows_have_an_owner_too(spark, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: None)
    with session.stored_tables(spark):
        held = session.materialize(spark.range(4), "x")
        assert held.count() == 4 and held.storageLevel.useMemory
    assert not held.storageLevel.useMemory


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", ["kmeans_fit", "term_postings", "stream_dictionary_versions"])
def test_no_folder_is_left_behind_a_query(spark, shared, name):
    with session.stored_tables(spark):
        assert catalog.queries()[name](spark, SF).count() > 0
        assert os.listdir(shared)
    assert os.listdir(shared) == []


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "notes/a.json")
    assert storage.matching(spark, str(tmp_path / "notes/*")) == []
    assert storage.write_new_text(spark, path, "één") and not storage.write_new_text(spark, path, "two")
    assert storage.read_text(spark, path) == "één" and storage.exists(spark, path)
    assert [p.rsplit("/", 1)[1] for p in storage.matching(spark, str(tmp_path / "notes/*.json"))] == ["a.json"]
    assert storage.remove(spark, path) and not storage.remove(spark, path)
