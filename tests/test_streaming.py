import os
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from wingspan.operators.expectations import assert_complete_mapping, require_columns
from wingspan.streaming import ingest


def test_incremental_append_processes_only_new_files(spark):
    root = tempfile.mkdtemp(prefix="wingspan-live-")
    src, sink, ck = f"{root}/src", f"{root}/sink", f"{root}/ck"
    schema = "flight_id long, airline string, event_date date, altitude double"
    b1 = spark.createDataFrame([(1, "A", dt.date(2001, 1, 1), 100.0), (2, "B", dt.date(2001, 1, 1), -5.0)], schema)
    ingest.append_batch(b1, src, ["airline", "event_date"])
    stream = spark.readStream.schema(b1.schema).parquet(src).filter("altitude >= 0")
    q = ingest.run_to_sink(stream, sink, ck, "live1")
    assert spark.read.parquet(sink).count() == 1
    assert q.lastProgress is not None
    b2 = spark.createDataFrame([(3, "A", dt.date(2001, 1, 2), 50.0)], schema)
    ingest.append_batch(b2, src, ["airline", "event_date"])
    stream = spark.readStream.schema(b1.schema).parquet(src).filter("altitude >= 0")
    q = ingest.run_to_sink(stream, sink, ck, "live2")
    assert q.lastProgress["numInputRows"] == 1          # only the new file
    assert sorted(r.flight_id for r in spark.read.parquet(sink).collect()) == [1, 3]


def test_foreach_batch_index_sync(spark):
    root = tempfile.mkdtemp(prefix="wingspan-sync-")
    src, idx, ck = f"{root}/src", f"{root}/index", f"{root}/ck"
    schema = "chunk_id string, chunk string"
    ingest.append_batch(spark.createDataFrame([("1|0", "a"), ("1|1", "b")], schema), src)
    ingest.sync_changed(spark.readStream.schema(schema).parquet(src), idx, "chunk_id", ck)
    ingest.append_batch(spark.createDataFrame([("1|1", "b2"), ("2|0", "c")], schema), src)
    ingest.sync_changed(spark.readStream.schema(schema).parquet(src), idx, "chunk_id", ck)
    got = {r.chunk_id: r.chunk for r in spark.read.parquet(idx).collect()}
    assert got == {"1|0": "a", "1|1": "b2", "2|0": "c"}


def test_mapping_and_required_columns(spark):
    vals = spark.createDataFrame([("A320",), ("B737",)], "aircraft_type string")
    mp = spark.createDataFrame([("A320", "x")], "aircraft_type string, manual string")
    with pytest.raises(ValueError):
        assert_complete_mapping(vals, mp, "aircraft_type")
    assert_complete_mapping(vals.filter("aircraft_type = 'A320'"), mp, "aircraft_type")
    with pytest.raises(ValueError):
        require_columns(vals, ["aircraft_type", "tail_number"])


def test_progress_of_more_micro_batches_than_a_query_keeps(spark):
    root = tempfile.mkdtemp(prefix="wingspan-many-")
    schema = "id long"
    spark.range(130).repartition(130, "id").write.parquet(f"{root}/src")
    n = len([p for p in os.listdir(f"{root}/src") if p.endswith(".parquet")])
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/src").observe(
            "seen", F.count(F.lit(1)).alias("rows"))
        got = ingest.drained_progress(stream.writeStream.format("noop").option("checkpointLocation", f"{root}/ck"))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert len(got) >= n // 4 > 5
    assert sum(p["observedMetrics"]["seen"]["rows"] for p in got) == 130


def test_index_sync_goes_on_after_a_stop_while_replacing(spark):
    root = tempfile.mkdtemp(prefix="wingspan-stop-")
    src, idx, ck = f"{root}/src", f"{root}/index", f"{root}/ck"
    schema = "chunk_id string, chunk string"
    ingest.append_batch(spark.createDataFrame([("1|0", "a")], schema), src)
    ingest.sync_changed(spark.readStream.schema(schema).parquet(src), idx, "chunk_id", ck)
    whole = spark.read.parquet(idx)
    more = spark.createDataFrame([("1|1", "b")], schema).withColumn("content_hash", F.sha2("chunk", 256))
    whole.unionByName(more).write.parquet(f"{idx}_e1")     # the merge of batch 1 is complete ...
    os.rename(idx, f"{root}/gone")                         # ... and the index is being replaced
    ingest.append_batch(spark.createDataFrame([("1|1", "b")], schema), src)
    ingest.sync_changed(spark.readStream.schema(schema).parquet(src), idx, "chunk_id", ck)
    assert {r.chunk_id: r.chunk for r in spark.read.parquet(idx).collect()} == {"1|0": "a", "1|1": "b"}
    assert not os.path.exists(f"{idx}_e1")
