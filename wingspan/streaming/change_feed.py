"""The change feed of a keyed table as a stream (SNK12, SNK11, ST7).

Input: a stream of row versions (key, version, deleted flag, columns).  Keyed
streaming state holds the row in force of every key.  Each micro-batch hands on
the net change of the keys it touches: ``inserted``, ``updated`` or ``deleted``
with the row before and after, nothing where the content stays as it was.

* **Late rows and replays.**  The row in force is the largest by version, then
  deletion, then content.  A row that is not larger changes nothing, so the
  table reached is the same for every order and grouping of the input.  A
  deleted key keeps its version, so that a late row does not bring it back.
* **State** is one row a key with its content, kept by Spark's own streaming
  aggregation in the RocksDB provider: on the executors' disks, snapshots in
  the checkpoint folder.  The row before a change comes from the earlier epochs
  of the feed, by a join on the keys that the micro-batch touches.
* **Restart.**  Every epoch of the feed is a folder of its own and written
  before anything reads it; a batch that is run again after a failure finds the
  earlier state and writes the same folder again.

Rows without key or version are an error; a null deletion flag is no deletion.
An empty stream has an empty feed.  Columns may have any name but those of the
feed (``change``, ``version``, ``before``, ``after``), which only structs carry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wingspan.operators.versioned_index import VersionedIndex
from wingspan.session import file_listing

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# whole microseconds both ways
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def change_stream(rows: DataFrame, key: str, version: str = "version", deleted: str = "deleted") -> DataFrame:
    """(key, change, version, before, after) of a stream of row versions; the last two are structs of the columns.

    The rows as they stream: the row in force of every key that a micro-batch
    touches, as ``after``.  :func:`drain_feed` adds ``before`` and drops the
    keys whose content stays.
    """
    columns = [c for c in rows.columns if c not in (key, version, deleted)]
    known = F.col(f"`{key}`").isNotNull() & F.col(f"`{version}`").isNotNull()
    gone = F.coalesce(F.col(f"`{deleted}`").cast("boolean"), F.lit(False))
    image = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _JSON)
    taken = rows.filter(F.assert_true(known, f"change rows without {key} or {version}").isNull()).select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{version}`").cast("long").alias("version"), gone.alias("gone"),
        F.when(gone, F.lit("")).otherwise(image).alias("image"))
    now = taken.groupBy("key").agg(F.max(F.struct("version", "gone", "image")).alias("now"))
    shape = StructType([rows.schema[c] for c in columns])
    return now.select(F.col("key").alias(key), F.when(F.col("now.gone"), "deleted").otherwise("updated").alias("change"),
                      F.col("now.version").alias("version"), F.lit(None).cast(shape).alias("before"),
                      F.when(~F.col("now.gone"), F.from_json("now.image", shape, _JSON)).alias("after"))


def _net_changes(batch: DataFrame, earlier: DataFrame, key: str) -> DataFrame:
    """The rows in force of one micro-batch against the images that the earlier epochs of the feed lead to."""
    last = earlier.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max_by("after", "epoch").alias("_was"))
    both = batch.join(last, F.col(f"`{key}`") == F.col("_key"), "left")
    was, now = F.col("_was"), F.col("after")
    change = F.when(was.isNull(), "inserted").when(now.isNull(), "deleted").otherwise("updated")
    return both.filter(~F.to_json(was, _JSON).eqNullSafe(F.to_json(now, _JSON))).select(
        F.col(f"`{key}`"), change.alias("change"), "version", was.alias("before"), "after")


def drain_feed(feed: DataFrame, path: str, checkpoint: str, key: str, index: VersionedIndex | None = None,
               name: str = "changes", step=lambda what: None):
    """Drain the feed: every epoch into its own folder under ``path``, then into ``index`` if there is one."""
    spark = feed.sparkSession
    root = path.rstrip("/")

    def epoch_of(batch: DataFrame, epoch: int) -> None:
        folder = f"{root}/epoch={epoch}"
        earlier = read_feed(batch.sparkSession, root, batch).filter(F.col("epoch") < epoch)
        _net_changes(batch, earlier, key).write.mode("overwrite").parquet(folder)
        step("feed written")
        if index is not None:
            made = batch.sparkSession.read.schema(batch.schema).parquet(folder)
            index.apply(made.select(key, "change", "version", "after.*"), epoch=epoch, feed=name, order="version")
            step("index written")

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        q = (feed.writeStream.foreachBatch(epoch_of).outputMode("update")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(_PROVIDER, before)
    q.awaitTermination()
    return q


def read_feed(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """All epochs of a written feed, with the number of each; no rows where none is written."""
    schema = StructType(list(like.schema.fields)).add("epoch", "long")
    if not file_listing(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def table_of(feed: DataFrame, key: str) -> DataFrame:
    """The table that a written feed leads to: the last row after a change of every key that is not deleted."""
    last = feed.groupBy(key).agg(F.max_by(F.struct("change", "after"), F.struct("epoch", "version")).alias("_l"))
    return last.filter(F.col("_l.change") != "deleted").select(key, "_l.after.*")
