"""Compaction of versioned rows: the same rows before, during and after; old files go."""

import os

import pytest

from framecut.sources import sinks

ROW = "clip_id string, string_vid string, n int"
KEY = "string_vid string"


def rows(spark, path):
    return sorted(tuple(r) for r in sinks.current(spark, path).select("clip_id", "string_vid", "n").collect())


def put(spark, path, docs, keys):
    sinks.replace_keys(spark.createDataFrame(docs, ROW), spark.createDataFrame([(k,) for k in keys], KEY), path)


@pytest.fixture()
def store(spark, scratch):
    path = f"{scratch}/store"
    put(spark, path, [("1", "a", 1), ("2", "b", 1), ("3", "c", 1)], "abc")
    put(spark, path, [("1", "a", 2), ("4", None, 2)], ["a", None])
    put(spark, path, [], "c")
    return path


def folders(path, part):
    return sorted(n for n in os.listdir(f"{path}/{part}") if n.startswith("round="))


def test_readers_see_the_same_rows(spark, store, monkeypatch):
    want, during = rows(spark, store), []
    assert [r[0] for r in want] == ["1", "2"]  # a null key equals nothing, as in any join
    opened, publish = sinks.current(spark, store), sinks.publish

    def watched(keys, path, this):
        during.append(rows(spark, path))
        publish(keys.where("string_vid = 'a'"), path, this)  # as if a reader came in the middle
        during.append(rows(spark, path))
        publish(keys.where("string_vid <> 'a'"), path, this)

    monkeypatch.setattr(sinks, "publish", watched)
    assert sinks.compact(spark, store) == len(want)
    assert during == [want, want] and rows(spark, store) == want
    assert sinks.vacuum(spark, store) == 0  # a second compaction lets the first rounds go
    assert opened.count() == len(want)


def test_old_files_go_and_rounds_go_on(spark, store):
    want = rows(spark, store)
    sinks.compact(spark, store)
    put(spark, store, [("5", "d", 1)], "d")
    sinks.compact(spark, store)
    assert sinks.vacuum(spark, store) == 6
    assert rows(spark, store) == sorted([*want, ("5", "d", 1)])
    assert sinks.vacuum(spark, store, keep=1) == 4
    assert len(folders(store, "documents")) == len(folders(store, "rounds")) == 1
    put(spark, store, [("1", "a", 9)], "a")
    assert rows(spark, store) == sorted([("1", "a", 9), ("2", "b", 1), ("5", "d", 1)])


def test_a_failed_compaction_changes_nothing(spark, store, monkeypatch):
    want = rows(spark, store)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "publish", fail)
        with pytest.raises(OSError):
            sinks.compact(spark, store)
    assert rows(spark, store) == want and sinks.vacuum(spark, store, keep=1) == 0
    sinks.compact(spark, store)
    assert sinks.vacuum(spark, store, keep=1) > 0 and rows(spark, store) == want


def test_nothing_published_and_bad_keep(spark, scratch):
    assert sinks.compact(spark, f"{scratch}/none") == 0 and sinks.vacuum(spark, f"{scratch}/none") == 0
    with pytest.raises(ValueError):
        sinks.vacuum(spark, f"{scratch}/none", keep=0)
