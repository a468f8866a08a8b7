"""Replay and re-processing queries (RP1-RP6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.operators import replay as rp
from wingspan.plans import common as C
from wingspan.plans.registry import all_oracles, all_queries, query

G = "replay"

_MAP = """
, hasf AS (SELECT * FROM flights f WHERE EXISTS (SELECT 1 FROM clean t WHERE t.flight_id = f.flight_id))
, tmpl AS (SELECT origin, destination, min(flight_id) AS template_flight_id FROM hasf GROUP BY ALL)
, missing AS (SELECT * FROM flights f WHERE NOT EXISTS (SELECT 1 FROM clean t WHERE t.flight_id = f.flight_id))
, mp AS (SELECT m.flight_id, t.template_flight_id FROM missing m JOIN tmpl t
         ON t.origin = m.origin AND t.destination = m.destination)
, cl AS (SELECT mp.flight_id, mp.template_flight_id, c.record_sequence, c.event_ts, c.flight_phase,
         c.altitude FROM mp JOIN clean c ON c.flight_id = mp.template_flight_id)
"""


def _clone(spark, d):
    tel = C.telemetry(spark, d)
    return rp.clone_records(tel, rp.template_mapping(C.flights(spark, d), tel)).select(
        "flight_id", "template_flight_id", "record_sequence", "event_ts", "flight_phase", "altitude")


@query("replay_clone", group=G, oracle=C.TEL_PRE + _MAP + """
SELECT flight_id, template_flight_id, record_sequence, event_ts, flight_phase,
  round(altitude, 6) AS altitude FROM cl""")
def replay_clone(spark, d):
    """RP1 / JN11: flights without records cloned from a same-route template."""
    return _clone(spark, d)


@query("retime", group=G, oracle=C.TEL_PRE + _MAP + """
SELECT cl.flight_id, cl.template_flight_id, cl.record_sequence,
  f.departure_time + (cl.event_ts - min(cl.event_ts) OVER (PARTITION BY cl.flight_id)) AS event_ts,
  CAST(f.departure_time + (cl.event_ts - min(cl.event_ts) OVER (PARTITION BY cl.flight_id)) AS DATE)
    AS event_date, cl.flight_phase, round(cl.altitude, 6) AS altitude
FROM cl LEFT JOIN flights f ON f.flight_id = cl.flight_id""")
def retime(spark, d):
    """RP3: cloned flights moved to their own departure time."""
    return rp.retime(_clone(spark, d), C.flights(spark, d))


@query("window_inject", group=G, oracle=C.TEL_PRE + """
, tg AS (SELECT flight_id FROM flights WHERE has_anomaly
         EXCEPT SELECT flight_id FROM clean WHERE anomaly_type IS NOT NULL)
, x AS (SELECT c.*, tg.flight_id IS NOT NULL AS target, row_number() OVER (PARTITION BY c.flight_id,
    c.flight_phase ORDER BY record_sequence, event_ts, egt_eng1, egt_eng2, vibration_n1_eng1,
    vibration_n1_eng2) AS idx FROM clean c LEFT JOIN tg ON tg.flight_id = c.flight_id)
, y AS (SELECT *, target AND flight_phase = 'CRUISE' AND idx BETWEEN 1 AND 3 AS hit FROM x)
SELECT flight_id, record_sequence, event_ts, flight_phase,
  round(CASE WHEN hit THEN egt_eng1 + 45.0 ELSE egt_eng1 END, 6) AS egt_eng1,
  round(CASE WHEN hit THEN egt_eng2 + 45.0 ELSE egt_eng2 END, 6) AS egt_eng2,
  round(CASE WHEN hit THEN vibration_n1_eng1 * 1.8 ELSE vibration_n1_eng1 END, 6) AS vibration_n1_eng1,
  round(CASE WHEN hit THEN vibration_n1_eng2 * 1.8 ELSE vibration_n1_eng2 END, 6) AS vibration_n1_eng2,
  hit AS injected FROM y""")
def window_inject(spark, d):
    """RP2: signature injected into the cruise window of labelled flights lacking records' labels."""
    tel = C.telemetry(spark, d)
    targets = (C.flights(spark, d).filter("has_anomaly").select("flight_id")
               .join(tel.filter(F.col("anomaly_type").isNotNull()).select("flight_id"),
                     "flight_id", "left_anti"))
    shown = ["flight_id", "record_sequence", "event_ts", "flight_phase", "egt_eng1", "egt_eng2",
             "vibration_n1_eng1", "vibration_n1_eng2"]
    return rp.inject_window(tel.select(*shown), targets).select(*shown, "injected")


@query("group_adjust", group=G, oracle=C.TEL_PRE + """
, off AS (SELECT concat('AL', lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')) AS airline,
    CASE r.r_name WHEN 'EUROPE' THEN 2 WHEN 'ASIA' THEN 1 ELSE 0 END AS offset_years
    FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey)
SELECT a.tail_number, a.airline, coalesce(o.offset_years, 0) AS offset_years,
  greatest(a.aircraft_age_years - coalesce(o.offset_years, 0), 1) AS aircraft_age_years,
  CAST(a.last_maintenance_date - to_months(coalesce(o.offset_years, 0) * 12) AS DATE)
    AS last_maintenance_date
FROM aircraft_registry a LEFT JOIN off o ON o.airline = a.airline""")
def group_adjust(spark, d):
    """RP4: per-airline age shift with a floor, dates moved by whole years."""
    from wingspan.sources.bindings import bound
    offsets = bound(spark, d, "airlines").select(
        "airline", F.when(F.col("hub") == "EUROPE", 2).when(F.col("hub") == "ASIA", 1).otherwise(0)
        .alias("offset_years"))
    return rp.adjust_by_group(C.registry(spark, d), offsets).select(
        "tail_number", "airline", "offset_years", "aircraft_age_years", "last_maintenance_date")


@query("quota_sample", group=G, oracle=C.TEL_PRE + """
, fa AS (SELECT f.flight_id, r.airline FROM flights f JOIN aircraft_registry r ON r.tail_number = f.tail_number)
, q AS (SELECT *, row_number() OVER (PARTITION BY airline ORDER BY md5(CAST(flight_id AS VARCHAR)),
    flight_id) AS rn, count(*) OVER (PARTITION BY airline) AS n FROM fa)
SELECT flight_id, airline FROM q WHERE rn <= round_even(n * 0.25, 0)""")
def quota_sample(spark, d):
    """RP5: exact 25% quota per airline in hash order."""
    fa = C.flights(spark, d).join(C.registry(spark, d).select("tail_number", "airline"), "tail_number")
    return rp.quota_sample(fa.select("flight_id", "airline"), "airline", "flight_id")


@query("extend_events", group=G, oracle=f"""
WITH pe AS ({all_oracles()['peak_events']})
SELECT flight_id, anomaly_type, anomaly_severity, flight_phase_at_peak, peak_egt,
  event_start_timestamp, event_duration_seconds, false AS derived FROM pe
UNION ALL SELECT flight_id, anomaly_type, anomaly_severity, 'APPROACH_LANDING', round(peak_egt * 0.9, 6),
  event_start_timestamp + to_seconds(CAST(event_duration_seconds AS BIGINT)), 0.0, true FROM pe
WHERE anomaly_severity IN ('HIGH', 'CRITICAL')""")
def extend_events(spark, d):
    """RP6 / UN2: anomaly events plus derived landing events."""
    ev = all_queries()["peak_events"](spark, d).select(
        "flight_id", "anomaly_type", "anomaly_severity", "flight_phase_at_peak", "peak_egt",
        "event_start_timestamp", "event_duration_seconds")
    return rp.extend_events(ev)
