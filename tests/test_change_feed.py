"""The streamed change feed: batch comparison, late rows, replays, deletions, restarts, the index behind it."""

import datetime as dt
import itertools
import tempfile

import pytest
from pyspark.sql import functions as F

from wingspan.operators.search import changed_rows
from wingspan.operators.versioned_index import VersionedIndex
from wingspan.streaming import change_feed as C
from wingspan.streaming import ingest

SCHEMA = "chunk_id string, version long, deleted boolean, chunk string, at timestamp, key double, image string"
T = dt.datetime(2001, 2, 3, 4, 5, 6, 789123)


class Feed:
    def __init__(self, spark, index=False):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="wingspan-feed-")
        self.index = VersionedIndex(spark, f"{self.root}/index", "chunk_id", "chunk") if index else None
        spark.createDataFrame([], SCHEMA).write.parquet(f"{self.root}/src")

    def put(self, *rows):
        full = [(k, v, d, c, T, 0.5, "i") for k, v, d, c in rows]
        ingest.append_batch(self.spark.createDataFrame(full, SCHEMA).coalesce(2), f"{self.root}/src")
        return self

    def drain(self, step=lambda what: None):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/src")
        self.changes = C.change_stream(stream, "chunk_id")
        C.drain_feed(self.changes, f"{self.root}/feed", f"{self.root}/ck", "chunk_id", self.index, step=step)
        return self

    def rows(self):
        return C.read_feed(self.spark, f"{self.root}/feed", self.changes)

    def list(self):
        return sorted((r.epoch, r.chunk_id, r.change, r.version, r.before and r.before.chunk,
                       r.after and r.after.chunk) for r in self.rows().collect())

    def table(self):
        return {r.chunk_id: r.chunk for r in C.table_of(self.rows(), "chunk_id").collect()}


def test_images_late_rows_deletions_and_replays(spark):
    f = Feed(spark, index=True)
    f.put(("a", 1, False, "x"), ("b", 1, False, "y"), ("c", 1, None, None)).drain()
    assert f.list() == [(0, "a", "inserted", 1, None, "x"), (0, "b", "inserted", 1, None, "y"),
                        (0, "c", "inserted", 1, None, None)]
    f.put(("a", 3, False, "x3"), ("a", 2, False, "x2"), ("b", 2, True, None), ("c", 2, False, None)).drain()
    assert f.list()[3:] == [(1, "a", "updated", 3, "x", "x3"), (1, "b", "deleted", 2, "y", None)]
    before = f.index.manifest()
    f.put(("a", 3, False, "x3"), ("a", 2, False, "x2"), ("b", 1, False, "y"), ("b", 2, True, None)).drain()
    assert len(f.list()) == 5  # late rows and repeats hand on nothing, a deleted key stays deleted
    assert f.index.manifest()["segments"] == before["segments"]
    f.put(("b", 5, False, "back")).drain()
    assert f.list()[5:] == [(3, "b", "inserted", 5, None, "back")]
    assert f.table() == {"a": "x3", "b": "back", "c": None}
    assert {r.chunk_id: r.chunk for r in f.index.rows().collect()} == f.table()
    image = f.rows().filter("chunk_id = 'b' and epoch = 3").first().after
    assert (image["at"], image["key"], image["image"]) == (T, 0.5, "i")


def test_every_order_and_grouping_leads_to_one_table(spark):
    rows = [("a", 1, False, "p"), ("a", 1, False, "q"), ("a", 2, True, None)]
    for order in itertools.islice(itertools.permutations(rows), 0, 6, 2):
        f = Feed(spark)
        f.put(order[0]).drain().put(*order[1:]).drain()
        assert f.table() == {}
    f, g = Feed(spark), Feed(spark)
    f.put(*rows[:2]).drain()
    g.put(rows[1]).drain().put(rows[0]).drain()
    assert f.table() == g.table() == {"a": "q"}  # of one version the larger content


def test_equals_the_batch_comparison(spark):
    old = [(str(i), 1, False, f"text {i}") for i in range(200)]
    new = [(str(i), 2, False, f"text {i}" if i % 3 else f"new {i}") for i in range(50, 260)]
    gone = [(str(i), 2, True, None) for i in range(50)]
    f = Feed(spark, index=True)
    f.put(*old).drain().put(*new, *gone, *old[:30]).drain()
    a, b = (spark.createDataFrame([(r[0], r[3]) for r in t], "chunk_id string, chunk string") for t in (old, new))
    want = {(r.chunk_id, r.change) for r in changed_rows(a, b, "chunk_id", "chunk").collect()}
    assert {(r.chunk_id, r.change) for r in f.rows().filter("epoch = 1").collect()} == want
    assert f.table() == {r[0]: r[3] for r in new}
    assert {r.chunk_id: r.chunk for r in f.index.rows().collect()} == f.table()


@pytest.mark.parametrize("where", ["feed written", "index written"])
def test_goes_on_after_a_stop(spark, where):
    def stop(what):
        if what == where:
            raise RuntimeError("stopped")
    f = Feed(spark, index=True)
    f.put(("a", 1, False, "x"), ("b", 1, False, "y")).drain()
    f.put(("a", 2, False, "x2"), ("b", 2, True, None), ("c", 1, False, "z"))
    with pytest.raises(Exception):
        f.drain(stop)
    f.drain()
    assert f.list()[2:] == [(1, "a", "updated", 2, "x", "x2"), (1, "b", "deleted", 2, "y", None),
                            (1, "c", "inserted", 1, None, "z")]
    assert {r.chunk_id: r.chunk for r in f.index.rows().collect()} == {"a": "x2", "c": "z"} == f.table()


def test_empty_stream_and_rows_without_key(spark):
    f = Feed(spark).drain()
    assert f.rows().count() == 0 and f.table() == {}
    with pytest.raises(Exception, match="change rows without"):
        f.put((None, 1, False, "x")).drain()
    with pytest.raises(Exception, match="change rows without"):
        Feed(spark).put(("a", None, False, "x")).drain()


def test_no_python_call_a_key(spark, capsys):
    Feed(spark).drain().changes.explain()
    plan = capsys.readouterr().out
    assert "StateStoreSave" in plan and "Pandas" not in plan and "Python" not in plan


def test_images_come_from_the_last_change_of_a_key(spark):
    f = Feed(spark)
    f.put(("a", 1, False, "x"), ("b", 1, True, None)).drain().put(("a", 2, False, "y")).drain()
    f.put(("a", 3, False, "y"), ("b", 2, True, None)).drain().put(("a", 2, True, None), ("b", 1, False, "z")).drain()
    f.put(("a", 4, True, None), ("b", 3, False, "w")).drain()
    assert f.list() == [(0, "a", "inserted", 1, None, "x"), (1, "a", "updated", 2, "x", "y"),
                        (4, "a", "deleted", 4, "y", None), (4, "b", "inserted", 3, None, "w")]
