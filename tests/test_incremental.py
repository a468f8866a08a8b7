"""Refreshed gold tables: equal to a full computation after inserts, updates and deletes; what is read; stops."""

import random

import pytest
from pyspark.sql import functions as F

from wingspan.operators.incremental import GoldTable, Measure
from wingspan.streaming import change_feed as C
from wingspan.streaming import ingest

ROW = "g string, h int, x double, label string"
MEASURES = [Measure("n", "count", "1"), Measure("labelled", "count", "label"), Measure("total", "sum", "x"),
            Measure("mean", "avg", "x"), Measure("low", "min", "x"), Measure("high", "max", "x"),
            Measure("first_label", "min", "label")]


def _feed(spark, pairs):
    return spark.createDataFrame(pairs, f"before struct<{ROW}>, after struct<{ROW}>")


def _base(spark, rows):
    return spark.createDataFrame(rows, ROW)


def _rows(df):
    return [] if df is None else sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_a_full_computation(spark, tmp_path):
    rnd = random.Random(3)
    gold = GoldTable(spark, str(tmp_path / "gold"), ["g", "h"], MEASURES, buckets=4)

    def row():
        return (rnd.choice(["hot", "hot", "a", "b", "c", None]), rnd.choice([1, 2, None]),
                rnd.choice([None, 0.1, 0.2, -7.25, 1e7 + 0.3, rnd.uniform(-5, 5)]), rnd.choice([None, "p", "q"]))
    now, recomputed = [], 0
    for epoch in range(5):
        pairs = []
        for _ in range(120 if epoch == 0 else 25):
            kind = "insert" if epoch == 0 or len(now) < 30 else rnd.choice(["insert", "update", "delete", "delete"])
            before = None if kind == "insert" else now.pop(rnd.randrange(len(now)))
            after = None if kind == "delete" else row()
            pairs.append((before, after))
            if after is not None:
                now.append(after)
        base = _base(spark, now)
        recomputed += gold.refresh(_feed(spark, pairs).repartition(3), base, epoch)["recomputed"]
        assert _rows(gold.table()) == _rows(gold.full(base))
    assert recomputed > 0
    before = gold.manifest()
    assert gold.refresh(_feed(spark, pairs), base, 4)["groups"] == 0 and gold.manifest() == before  # a replay
    gold.refresh(_feed(spark, [(r, None) for r in now]), _base(spark, []), 5)
    assert _rows(gold.table()) == [] and gold.manifest()["buckets"] == {}


def test_reads_and_writes_only_what_a_change_touches(spark, tmp_path):
    rows = [(f"g{i % 50}", 1, float(i), "p") for i in range(1000)]
    gold = GoldTable(spark, str(tmp_path / "gold"), ["g", "h"], MEASURES, buckets=16)
    gold.refresh(_feed(spark, [(None, r) for r in rows]), epoch=0)
    first = dict(gold.manifest()["buckets"])
    done = gold.refresh(_feed(spark, [(rows[507], None), (None, ("g7", 1, 600.5, "p"))]), epoch=1)  # no extreme is lost
    assert done == {"groups": 1, "buckets": 1, "recomputed": 0, "base_rows": 0}
    second = gold.manifest()["buckets"]
    assert sum(first[b] != second[b] for b in first) == 1
    left = [r for i, r in enumerate(rows) if i not in (507, 3)] + [("g7", 1, 600.5, "p")]
    done = gold.refresh(_feed(spark, [(rows[3], None)]), _base(spark, left), epoch=2)  # the minimum of g3
    assert done == {"groups": 1, "buckets": 1, "recomputed": 1, "base_rows": 19}
    assert _rows(gold.table()) == _rows(gold.full(_base(spark, left)))
    shown = _rows(gold.table())
    assert sum(x.startswith("work/") for x in gold.vacuum()) == 3 and gold.vacuum() == []
    assert _rows(gold.table()) == shown and gold.versions() == [3]
    with pytest.raises(ValueError, match="base table"):
        gold.refresh(_feed(spark, [(rows[4], None)]), epoch=3)
    with pytest.raises(Exception, match="takes away"):
        gold.refresh(_feed(spark, [(("new", 1, 1.0, "p"), None)]), epoch=3)


@pytest.mark.parametrize("where", ["changes written", "merged groups written", "buckets written", "manifest written"])
def test_a_stopped_refresh_changes_nothing(spark, tmp_path, where):
    def stop(what):
        if what == where:
            raise RuntimeError("stopped")
    gold = GoldTable(spark, str(tmp_path / "gold"), ["g"], MEASURES[:3], buckets=2)
    gold.refresh(_feed(spark, [(None, ("a", 1, 1.0, None))]), epoch=0)
    change = _feed(spark, [(None, ("a", 1, 2.0, "p")), (None, ("b", 1, None, None))])
    with pytest.raises(RuntimeError):
        gold.refresh(change, epoch=1, step=stop)
    assert _rows(gold.table()) == [("a", 1, 0, 1.0)]
    gold.refresh(change, epoch=1)
    assert _rows(gold.table()) == [("a", 2, 1, 3.0), ("b", 1, 0, None)]


def test_empty_feed_and_numbers_that_are_not_finite(spark, tmp_path):
    gold = GoldTable(spark, str(tmp_path / "gold"), ["g"], MEASURES[2:4])
    assert gold.refresh(_feed(spark, []), epoch=0)["groups"] == 0 and gold.table() is None
    rows = [("a", 1, float("nan"), None), ("a", 1, float("inf"), None), ("a", 1, 4.0, None), ("b", 1, None, None)]
    gold.refresh(_feed(spark, [(None, r) for r in rows] + [(None, None)]), epoch=1)
    assert _rows(gold.table()) == [("a", 4.0, 4.0), ("b", None, None)]


def test_follows_the_streamed_change_feed(spark, tmp_path):
    schema = "id long, version long, deleted boolean, " + ROW
    gold = GoldTable(spark, str(tmp_path / "gold"), ["g"], MEASURES, buckets=4)
    batches = [[(i, 1, False, f"g{i % 3}", 1, float(i), "p") for i in range(30)],
               [(i, 2, i % 2 == 0, f"g{i % 4}", 1, i / 2, "q") for i in range(12)]]
    for epoch, batch in enumerate(batches):
        ingest.append_batch(spark.createDataFrame(batch, schema), str(tmp_path / "src"))
        feed = C.change_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "src")), "id")
        C.drain_feed(feed, str(tmp_path / "feed"), str(tmp_path / "ck"), "id")
        written = C.read_feed(spark, str(tmp_path / "feed"), feed)
        base = C.table_of(written, "id")
        gold.refresh(written.filter(F.col("epoch") == epoch), base, epoch)
        assert _rows(gold.table()) == _rows(gold.full(base))
