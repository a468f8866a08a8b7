"""Streaming queries: results of ``availableNow`` runs read back in batch (ST1-ST4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.operators import text as T
from wingspan.operators.versioned_index import VersionedIndex
from wingspan.plans import common as C
from wingspan.plans.registry import all_oracles, query
from wingspan.session import scratch_path
from wingspan.sources.driver import read_table
from wingspan.streaming import change_feed as CF
from wingspan.streaming import ingest

G = "streaming"
_EVENTS_AS_TELEMETRY = """
, stg AS (SELECT user_id AS flight_id, CAST(event_id AS INT) AS record_sequence, ts AS event_ts,
    CASE WHEN event_type = 'view' THEN 'CRUISE' ELSE 'CLIMB' END AS flight_phase,
    CASE WHEN event_type = 'error' THEN 'EGT_EXCEEDANCE' END AS anomaly_type,
    CASE WHEN event_type = 'error' THEN 'HIGH' END AS anomaly_severity,
    value * 700.0 AS altitude, 150.0 + value * 6.0 AS indicated_airspeed,
    500.0 + value * 4.0 AS egt_eng1, 500.0 + value * 4.0 AS egt_eng2,
    value / 10.0 AS vibration_n1_eng1, value / 10.0 AS vibration_n1_eng2,
    value / 20.0 AS vibration_n2_eng1, value / 20.0 AS vibration_n2_eng2,
    value * 100.0 AS fuel_flow_eng1, value * 100.0 AS fuel_flow_eng2,
    40.0 + value AS oil_pressure_eng1, 45.0 - value AS oil_pressure_eng2,
    2800.0 + value AS hyd_press_sys1, 3000.0 - value AS hyd_press_sys2, 2900.0 + value AS hyd_press_sys3
  FROM events)
, stg_clean AS (SELECT * FROM stg WHERE event_ts IS NOT NULL AND flight_id IS NOT NULL
  AND altitude >= 0 AND oil_pressure_eng1 >= 0 AND oil_pressure_eng2 >= 0)
"""


def _r(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@query("stream_union_ingest", group=G, oracle=C.TEL_PRE + _EVENTS_AS_TELEMETRY + f"""
SELECT flight_id, record_sequence, event_ts, flight_phase, anomaly_type, anomaly_severity,
  {_r(C.SENSORS)} FROM (SELECT * FROM clean UNION ALL SELECT * FROM stg_clean)""")
def stream_union_ingest(spark, d):
    """ST1 + ST2: two bronze feeds, two append flows, one silver sink (availableNow)."""
    sink, _ = ingest.ingest_union(spark, d)
    return ingest.read_sink(spark, sink)


@query("stream_static_enrich", group=G, oracle=all_oracles()["enriched_telemetry"])
def stream_static_enrich(spark, d):
    """ST3: stream-static enrichment; equals the batch enrichment once drained."""
    sink = ingest.enrich_stream(spark, d, C.flights(spark, d), C.registry(spark, d))
    return ingest.read_sink(spark, sink)


def chunk_versions(spark, d) -> tuple:
    """Stand-in input: line chunks as version 1; sentence chunks, dropped line chunks and late rows as version 2."""
    docs = read_table(spark, d, "documents")
    cols = ["chunk_id", "chunk", "lang", "source"]
    old = T.section_chunks(docs).select(*cols)
    new = T.section_chunks(docs.withColumn("text", F.regexp_replace("text", r"\. ", "\n"))).select(*cols)

    def rows(df, version, deleted):
        return df.withColumns({"version": F.lit(version).cast("long"), "deleted": F.lit(deleted)})
    gone = old.join(new.select("chunk_id"), "chunk_id", "left_anti")
    second = rows(new, 2, False).unionByName(rows(gone, 2, True)).unionByName(rows(old, 1, False))
    return rows(old, 1, False), second


def drained_feed(spark, d):
    """The feed of both batches and the index that it drives."""
    first, second = chunk_versions(spark, d)
    source, out, checkpoint = (scratch_path(spark, n) for n in ("chunk-versions", "chunk-feed", "ckpt-feed"))
    index = VersionedIndex(spark, scratch_path(spark, "feed-index"), "chunk_id", "chunk")
    for batch in (first, second):
        ingest.append_batch(batch, source)
        feed = CF.change_stream(spark.readStream.schema(first.schema).parquet(source), "chunk_id")
        CF.drain_feed(feed, out, checkpoint, "chunk_id", index)
    return CF.read_feed(spark, out, feed), index


_FEED_CTE = """
WITH o0 AS (SELECT doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos,
    unnest(string_split(text, chr(10))) AS chunk FROM documents)
, o AS (SELECT concat_ws('|', CAST(doc_id AS VARCHAR), CAST(pos AS VARCHAR)) AS chunk_id, sha256(chunk) AS h
  FROM o0 WHERE length(trim(chunk)) > 0)
, n0 AS (SELECT doc_id, unnest(generate_series(0, len(string_split(t, chr(10))) - 1)) AS pos,
    unnest(string_split(t, chr(10))) AS chunk FROM (SELECT doc_id, replace(text, '. ', chr(10)) AS t
    FROM documents))
, n AS (SELECT concat_ws('|', CAST(doc_id AS VARCHAR), CAST(pos AS VARCHAR)) AS chunk_id, sha256(chunk) AS h
  FROM n0 WHERE length(trim(chunk)) > 0)
"""


@query("change_feed", group=G, oracle=_FEED_CTE + """
SELECT 0::BIGINT AS epoch, chunk_id, 'inserted' AS change, 1::BIGINT AS version, NULL::VARCHAR AS before_hash,
  h AS after_hash FROM o
UNION ALL SELECT 1, coalesce(n.chunk_id, o.chunk_id), CASE WHEN o.chunk_id IS NULL THEN 'inserted'
  WHEN n.chunk_id IS NULL THEN 'deleted' ELSE 'updated' END, 2, o.h, n.h
FROM o FULL JOIN n ON o.chunk_id = n.chunk_id WHERE o.h IS DISTINCT FROM n.h""")
def change_feed(spark, d):
    """SNK12 + SNK11: streamed feed of re-chunked documents, before and after each change; late rows add nothing."""
    feed, _ = drained_feed(spark, d)
    return feed.select("epoch", "chunk_id", "change", "version", F.sha2("before.chunk", 256).alias("before_hash"),
                       F.sha2("after.chunk", 256).alias("after_hash"))


@query("feed_index", group=G, oracle=_FEED_CTE + "SELECT chunk_id, h AS content_hash FROM n")
def feed_index(spark, d):
    """SNK12 + ST7: the versioned index that the streamed change feed keeps in step."""
    return drained_feed(spark, d)[1].rows().select("chunk_id", "content_hash")
