"""Published tables: half-written data, repeats, conflicts, compaction, buckets."""

import threading

import pytest
from pyspark.sql import functions as F

from aerolith.sources import io
from aerolith.sources import manifest as M

SCHEMA = "k string, seq int, v int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(spark, path):
    return sorted(map(tuple, M.read(spark, path, SCHEMA).collect()))


def test_broken_cache_is_a_miss(spark, tmp_path):
    path, calls = str(tmp_path / "cache"), []

    def compute():
        calls.append(1)
        return spark.range(3)

    (tmp_path / "cache" / "_temporary").mkdir(parents=True)   # what a failed write leaves
    assert io.cached_read(spark, path, compute).count() == 3
    assert io.cached_read(spark, path, compute).count() == 3 and len(calls) == 1


def test_appends_are_visible_once_each(spark, tmp_path):
    path = str(tmp_path)
    assert rows(spark, path) == []
    M.append(frame(spark, ("a", 1, 1)), path, run="r1")
    M.append(frame(spark, ("a", 1, 1)), path, run="r1")   # a repeat
    M.append(frame(spark, ("b", 1, 2)), path, run="r2")
    M.write_folder(frame(spark, ("lost", 1, 3)), path)    # a writer that died before it published
    assert rows(spark, path) == [("a", 1, 1), ("b", 1, 2)]


def test_conflict(spark, tmp_path):
    path = str(tmp_path)
    base = M.snapshot(spark, path)
    M.commit(spark, path, base, [])
    with pytest.raises(M.Conflict):
        M.commit(spark, path, base, [])


def test_concurrent_appends_all_stay(spark, tmp_path):
    path, errors = str(tmp_path), []

    def add(i):
        try:
            M.append(frame(spark, (str(i), 1, i)), path)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and [r[2] for r in rows(spark, path)] == list(range(6))


def test_killed_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for b in range(3):
        M.append_batch(frame(spark, ("a", b, b)), path, b)
    newest = lambda df: df.groupBy("k").agg(F.max("seq").alias("seq"), F.max("v").alias("v"))
    with monkeypatch.context() as m:
        def killed(*a):
            raise KeyboardInterrupt
        m.setattr(M, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            M.compact(spark, path, SCHEMA, newest)
    assert rows(spark, path) == [("a", b, b) for b in range(3)]
    M.compact(spark, path, SCHEMA, newest)
    assert rows(spark, path) == [("a", 2, 2)] and len(M.snapshot(spark, path).folders) == 1
    M.append_batch(frame(spark, ("a", 1, 1)), path, 1)   # a batch that the compacted folder has
    assert rows(spark, path) == [("a", 2, 2)]


def test_merge_writes_touched_buckets_only(spark, tmp_path):
    path, bucket = str(tmp_path), F.substring("k", 1, 1)
    M.merge_keyed(frame(spark, ("a1", 0, 1), ("a1", 1, 2), ("b1", 0, 3), ("c1", 0, 4)), path, ["k"], ["seq"], bucket)
    before = {f["bucket"]: f["folder"] for f in M.snapshot(spark, path).folders}
    M.merge_keyed(frame(spark, ("b1", 5, 30), ("b2", 0, 31), ("d1", 0, 5)), path, ["k"], ["seq"], bucket)
    M.merge_keyed(frame(spark, ("b1", 2, 99)), path, ["k"], ["seq"], bucket)   # older than what is there
    after = {f["bucket"]: f["folder"] for f in M.snapshot(spark, path).folders}
    assert rows(spark, path) == [("a1", 1, 2), ("b1", 5, 30), ("b2", 0, 31), ("c1", 0, 4), ("d1", 0, 5)]
    assert {b for b in before if before[b] == after[b]} == {"a", "c"}
