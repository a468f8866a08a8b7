"""Structured Streaming ingest (ST1-ST7, SNK1, SNK2, SNK8, SRC1, SRC2).

Bronze and silver telemetry are streaming queries over files:

* sources read the driver parquet incrementally (``readStream`` with an
  explicit schema and a file-name filter);
* every flow has its own checkpoint under the session's shared
  ``spark.checkpoint.dir`` and appends into one parquet sink (SNK2);
* ``trigger(availableNow=True)`` processes what is there and stops, the
  batch equivalent of a pipeline refresh (ST5); a long-running job uses a
  processing-time trigger instead;
* the warn-rule counts of each micro-batch come from ``observe`` and are
  read from the progress of all batches (:func:`observed_enrichment`, no second scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wingspan.operators import telemetry as tm
from wingspan.session import file_listing, is_folder, remove_folder, scratch_path
from wingspan.sources.bindings import BINDINGS
from wingspan.sources.driver import read_table, table_path


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1000) -> DataFrame:
    """SRC1: a driver table as an unbounded file stream (schema taken from the batch file)."""
    schema = read_table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    path = table_path(sf_dir, name)
    if is_folder(spark, path):  # a table of part files
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def bound_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain binding applied to streaming inputs."""
    sql, tables = BINDINGS[name]
    return spark.sql(sql, **{t: stream_table(spark, sf_dir, t) for t in tables})


def staging_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2: the API staging feed - ``events`` rows shaped like telemetry.

    Label columns arrive untyped and are cast to string (the reference's
    void-typed staging labels); sensors map from ``value``.
    """
    ev = stream_table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        F.col("user_id").alias("flight_id"), F.col("event_id").cast("int").alias("record_sequence"),
        F.col("ts").alias("event_ts"),
        F.when(F.col("event_type") == "view", "CRUISE").otherwise("CLIMB").alias("flight_phase"),
        F.when(F.col("event_type") == "error", F.lit("EGT_EXCEEDANCE")).cast("string").alias("anomaly_type"),
        F.when(F.col("event_type") == "error", F.lit("HIGH")).cast("string").alias("anomaly_severity"),
        (v * 700.0).alias("altitude"), (150.0 + v * 6.0).alias("indicated_airspeed"),
        (500.0 + v * 4.0).alias("egt_eng1"), (500.0 + v * 4.0).alias("egt_eng2"),
        (v / 10.0).alias("vibration_n1_eng1"), (v / 10.0).alias("vibration_n1_eng2"),
        (v / 20.0).alias("vibration_n2_eng1"), (v / 20.0).alias("vibration_n2_eng2"),
        (v * 100.0).alias("fuel_flow_eng1"), (v * 100.0).alias("fuel_flow_eng2"),
        (40.0 + v).alias("oil_pressure_eng1"), (45.0 - v).alias("oil_pressure_eng2"),
        (2800.0 + v).alias("hyd_press_sys1"), (3000.0 - v).alias("hyd_press_sys2"),
        (2900.0 + v).alias("hyd_press_sys3"))


def run_to_sink(df: DataFrame, sink: str, checkpoint: str, name: str,
                partition_by: list[str] | None = None) -> StreamingQuery:
    """SNK1: append a stream into a parquet sink until the available input is done."""
    w = (df.writeStream.format("parquet").outputMode("append").option("path", sink)
         .option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def ingest_union(spark: SparkSession, sf_dir: str, sink: str | None = None) -> tuple[list[str], list]:
    """ST1 + ST2 + SNK2: bronze rules on both feeds, two flows into one silver table.

    A parquet file sink keeps one commit log per folder, so each flow
    appends into its own sub-folder of the table; the table is the union
    of its flow folders (see :func:`read_sink`).
    """
    sink = sink or scratch_path(spark, "silver_telemetry")
    raw = tm.bronze_telemetry(bound_stream(spark, sf_dir, "telemetry"))
    stg = tm.bronze_telemetry(staging_feed(spark, sf_dir))
    progress, paths = [], []
    for name, flow in (("raw_telemetry_flow", raw), ("staging_telemetry_flow", stg)):
        flow = tm.silver_telemetry(flow)
        path = f"{sink.rstrip('/')}/flow={name}"
        q = run_to_sink(flow, path, scratch_path(spark, f"ckpt-{name}"), name)
        progress.append(q.lastProgress)
        paths.append(path)
    return paths, progress


def enrich_stream(spark: SparkSession, sf_dir: str, flights: DataFrame, registry: DataFrame,
                  sink: str | None = None) -> str:
    """ST3: stream-static left joins (JN1, JN2) + derived columns into a sink.

    The static sides are re-read every micro-batch, so registry changes
    affect only records that arrive after them.
    """
    sink = sink or scratch_path(spark, "silver_enriched")
    tel = tm.bronze_telemetry(bound_stream(spark, sf_dir, "telemetry"))
    enriched = tm.enrich_telemetry(tel, flights, registry)
    run_to_sink(enriched, sink, scratch_path(spark, "ckpt-enrich"), "enrich_flow")
    return sink


def drained_progress(writer, poll_seconds: float = 0.2) -> list:
    """Drain a stream and return the progress of every micro-batch, in order.

    A query keeps its latest progress records only (100 by default), so they
    are gathered while it runs; a batch missed between two looks is an error,
    never a smaller count.
    """
    q = writer.trigger(availableNow=True).start()
    seen: dict[int, object] = {}
    running = True
    while running:
        running = not q.awaitTermination(poll_seconds)
        for p in q.recentProgress:
            if p["numInputRows"] or p["batchId"] not in seen:
                seen[p["batchId"]] = p
    missed = sorted(set(range(min(seen, default=0), max(seen, default=-1) + 1)) - set(seen))
    if missed:
        raise RuntimeError(f"progress of micro-batches {missed[:5]} was not seen")
    return [seen[b] for b in sorted(seen)]


def observed_enrichment(spark: SparkSession, sf_dir: str, flights: DataFrame, registry: DataFrame) -> dict:
    """DQ6 on a stream: the enrichment rules' violation counts over all micro-batches of a drained stream."""
    name = "stream_warnings"
    tel = tm.bronze_telemetry(bound_stream(spark, sf_dir, "telemetry"))
    enriched = tm.enrich_telemetry(tel, flights, registry, name)
    progress = drained_progress(enriched.writeStream.format("parquet").outputMode("append")
                                .option("path", scratch_path(spark, "warned"))
                                .option("checkpointLocation", scratch_path(spark, "ckpt-warned")).queryName(name))
    out: dict = {}
    for p in progress:
        row = p["observedMetrics"].get(name)
        for k, v in (row.asDict() if row is not None else {}).items():
            out[k] = out.get(k, 0) + int(v)
    return out


def read_sink(spark: SparkSession, sink: str | list[str], like: DataFrame | None = None) -> DataFrame:
    """ST4: the streamed table (one folder per flow) read back in batch."""
    paths = [sink] if isinstance(sink, str) else list(sink)
    out = None
    for p in paths:
        r = spark.read
        if like is not None:
            r = r.schema(like.schema)
        df = r.parquet(p)
        out = df if out is None else out.unionByName(df)
    return out


def append_batch(df: DataFrame, source_dir: str, partition_by: list[str] | None = None) -> None:
    """ST6 / SNK8: append one live batch of files to a stream's source folder."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(source_dir)


def sync_changed(stream: DataFrame, index_path: str, key: str, checkpoint: str,
                 content: str = "chunk", version: str | None = None) -> StreamingQuery:
    """ST7 / TX13: triggered index sync - each micro-batch upserts its rows by key.

    ``foreachBatch`` merges the batch into the index table (rows of the
    batch replace rows with the same key) and rewrites it; a re-run after a
    failure replays the batch idempotently because the merge is by key.  Of
    several rows of one key in a batch the one with the largest ``version``
    column stays (without one: the largest content hash).  An index that
    cannot be read is an error, never a new index.  The merged rows are
    complete beside the index before it is replaced, and a run that stopped
    in between goes on from them.  (:mod:`wingspan.operators.versioned_index`
    writes the changed rows only.)
    """
    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("content_hash", F.sha2(F.col(content), 256))
        newest = F.struct(*([version] if version else []), "content_hash")
        batch = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), newest).alias("_r")).select("_r.*")
        tmp = f"{index_path.rstrip('/')}_e{epoch}"
        if not file_listing(spark, f"{tmp}/_SUCCESS"):  # else a run stopped while it replaced the index
            if file_listing(spark, index_path):
                current = spark.read.parquet(index_path)
                merged = current.join(batch.select(key), key, "left_anti").unionByName(batch)
            else:
                merged = batch
            merged.write.mode("overwrite").parquet(tmp)
        spark.read.parquet(tmp).write.mode("overwrite").parquet(index_path)
        remove_folder(spark, tmp)

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
