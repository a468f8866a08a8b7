"""Operator telemetry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.operators import telemetry as tm
from wingspan.plans import common as C
from wingspan.plans.registry import query
from wingspan.sources.bindings import AS_OF_DATE

G = "telemetry"


def _r(cols):
    return ", ".join(f"round({c}, 6) AS {c.split('.')[-1]}" for c in cols)


@query("enriched_telemetry", group=G, oracle=C.TEL_PRE + f"""
SELECT flight_id, record_sequence, event_ts, flight_phase, anomaly_type, anomaly_severity,
  {_r(C.SENSORS)}, tail_number, origin, destination, departure_time, has_anomaly, airline,
  aircraft_type, aircraft_age_years, round(total_flight_hours, 6) AS total_flight_hours,
  last_maintenance_date, next_scheduled_maintenance,
  {_r(['engine_avg_egt', 'engine_avg_vibration', 'fuel_burn_rate', 'hydraulic_health_index'])}
FROM enriched""")
def enriched_telemetry(spark, d):
    """ST1-ST3 in batch form: bronze drop rules, two left joins, derived metrics."""
    return C.enriched_telemetry(spark, d)


_FS_MEASURES = ["flight_duration_hours", "max_altitude", "avg_cruise_speed", "total_fuel_burned",
                "max_egt_eng1", "max_egt_eng2", "max_vibration", "avg_oil_pressure_eng1",
                "avg_oil_pressure_eng2", "min_hydraulic_pressure"]


@query("flight_summary", group=G, oracle=C.TEL_PRE + f"""
SELECT flight_id, airline, aircraft_type, tail_number, origin, destination, departure_time,
  has_anomaly, anomaly_type, anomaly_severity, {_r(_FS_MEASURES)}, anomaly_record_count
FROM fs""")
def flight_summary(spark, d):
    """AG1: per flight and label, aggregated before the attribute joins."""
    return C.flight_summary(spark, d)


@query("aircraft_health", group=G, oracle=C.TEL_PRE + f"""
, st AS (SELECT tail_number, count(*) AS total_flights,
    sum(CASE WHEN has_anomaly THEN 1 ELSE 0 END) AS anomaly_flight_count,
    greatest(avg(max_egt_eng1), avg(max_egt_eng2)) AS avg_max_egt,
    avg(max_vibration) AS avg_max_vibration,
    avg(min_hydraulic_pressure) AS avg_min_hydraulic_pressure,
    max(departure_time) AS last_flight_date
  FROM fs GROUP BY tail_number)
SELECT st.tail_number, r.airline, r.aircraft_type, r.aircraft_age_years,
  round(r.total_flight_hours, 6) AS total_flight_hours,
  CAST(st.total_flights AS BIGINT) AS total_flights,
  CAST(st.anomaly_flight_count AS BIGINT) AS anomaly_flight_count,
  round(st.anomaly_flight_count / st.total_flights, 6) AS anomaly_rate,
  round(st.avg_max_egt, 6) AS avg_max_egt, round(st.avg_max_vibration, 6) AS avg_max_vibration,
  round(st.avg_min_hydraulic_pressure, 6) AS avg_min_hydraulic_pressure, st.last_flight_date,
  CAST(date_diff('day', r.last_maintenance_date, DATE '{AS_OF_DATE}') AS BIGINT)
    AS days_since_last_maintenance,
  CAST(date_diff('day', DATE '{AS_OF_DATE}', r.next_scheduled_maintenance) AS BIGINT)
    AS days_until_next_maintenance,
  round((st.anomaly_flight_count / st.total_flights) * 40
    + least(st.avg_max_vibration / 4.0, 1.0) * 30
    + (1.0 - least(st.avg_min_hydraulic_pressure / 3200.0, 1.0)) * 30, 6) AS health_risk_score
FROM st LEFT JOIN aircraft_registry r ON r.tail_number = st.tail_number""")
def aircraft_health(spark, d):
    """AG2 + JN4 + SC1 as of the fixed date."""
    out = tm.aircraft_health(C.flight_summary(spark, d), C.registry(spark, d), AS_OF_DATE)
    return out.withColumns({c: F.col(c).cast("bigint") for c in
                            ("days_since_last_maintenance", "days_until_next_maintenance")})


@query("event_bounds", group=G, oracle=C.TEL_PRE + """
SELECT flight_id, anomaly_type, min(event_ts) AS event_start_timestamp,
  CAST(date_diff('second', min(event_ts), max(event_ts)) AS DOUBLE) AS event_duration_seconds
FROM enriched WHERE anomaly_type IS NOT NULL GROUP BY flight_id, anomaly_type""")
def event_bounds(spark, d):
    """AG3 (bounds depend on the records only: no enrichment joins needed)."""
    return tm.event_bounds(C.telemetry(spark, d))


@query("peak_events", group=G, oracle=C.TEL_PRE + """
, a AS (SELECT *, least(oil_pressure_eng1, oil_pressure_eng2) AS min_oil FROM enriched
        WHERE anomaly_type IS NOT NULL)
, pk AS (SELECT *, row_number() OVER (PARTITION BY flight_id, anomaly_type
         ORDER BY engine_avg_egt DESC, event_ts, record_sequence, flight_phase, anomaly_severity,
                  engine_avg_vibration, min_oil) AS rn FROM a)
, b AS (SELECT flight_id, anomaly_type, min(event_ts) AS s, max(event_ts) AS e FROM a
        GROUP BY flight_id, anomaly_type)
SELECT pk.flight_id, pk.airline, pk.tail_number, pk.aircraft_type, pk.anomaly_type,
  pk.anomaly_severity, pk.flight_phase AS flight_phase_at_peak, round(pk.engine_avg_egt, 6) AS peak_egt,
  round(pk.engine_avg_vibration, 6) AS peak_vibration,
  round(pk.min_oil, 6) AS min_oil_pressure_during_event, b.s AS event_start_timestamp,
  CAST(date_diff('second', b.s, b.e) AS DOUBLE) AS event_duration_seconds
FROM pk JOIN b ON b.flight_id = pk.flight_id AND b.anomaly_type = pk.anomaly_type
WHERE pk.rn = 1""")
def peak_events(spark, d):
    """WN1 + AG3 + JN5 (gold anomaly events): one aggregate, attributes joined after."""
    return tm.anomaly_events_from_parts(C.telemetry(spark, d), C.flights(spark, d),
                                        C.registry(spark, d))


@query("route_on_time", group=G, oracle=C.TEL_PRE + """
, ra AS (SELECT origin, destination, avg(flight_duration_hours) AS avg_route_duration FROM fs
         GROUP BY origin, destination)
SELECT fs.flight_id, fs.anomaly_type, fs.anomaly_severity, fs.origin, fs.destination,
  round(fs.flight_duration_hours, 6) AS flight_duration_hours,
  round(ra.avg_route_duration, 6) AS avg_route_duration,
  CASE WHEN abs(fs.flight_duration_hours - ra.avg_route_duration) <= ra.avg_route_duration * 0.10
       THEN 1 ELSE 0 END AS is_on_time
FROM fs LEFT JOIN ra ON ra.origin = fs.origin AND ra.destination = fs.destination""")
def route_on_time(spark, d):
    """AG4 + JN6 + SF4."""
    return tm.route_on_time(C.flight_summary(spark, d)).select(
        "flight_id", "anomaly_type", "anomaly_severity", "origin", "destination",
        "flight_duration_hours", "avg_route_duration", "is_on_time")


_TOP = """
, tc AS (SELECT airline, anomaly_type, count(*) AS type_count FROM fs
         WHERE anomaly_type IS NOT NULL GROUP BY airline, anomaly_type)
, top AS (SELECT airline, anomaly_type AS top_anomaly_type, type_count FROM (
    SELECT *, row_number() OVER (PARTITION BY airline ORDER BY type_count DESC, anomaly_type) AS rn
    FROM tc) WHERE rn = 1)"""


@query("top_anomaly_per_airline", group=G, oracle=C.TEL_PRE + _TOP + """
SELECT airline, top_anomaly_type, CAST(type_count AS BIGINT) AS type_count FROM top""")
def top_anomaly_per_airline(spark, d):
    """AG7 + WN2 with the alphabetical tie-break (D3)."""
    return tm.top_anomaly_per_airline(C.flight_summary(spark, d))


@query("airline_operations", group=G, oracle=C.TEL_PRE + _TOP + """
, ra AS (SELECT origin, destination, avg(flight_duration_hours) AS avg_route_duration FROM fs
         GROUP BY origin, destination)
, ro AS (SELECT fs.*, CASE WHEN abs(fs.flight_duration_hours - ra.avg_route_duration)
         <= ra.avg_route_duration * 0.10 THEN 1 ELSE 0 END AS is_on_time
         FROM fs LEFT JOIN ra ON ra.origin = fs.origin AND ra.destination = fs.destination)
, ops AS (SELECT airline, count(*) AS total_flights, sum(flight_duration_hours) AS total_flight_hours,
          sum(CASE WHEN has_anomaly THEN 1 ELSE 0 END) AS anomaly_count, sum(is_on_time) AS on_time
          FROM ro GROUP BY airline)
, fleet AS (SELECT airline, count(DISTINCT tail_number) AS fleet_size,
            avg(aircraft_age_years) AS avg_fleet_age FROM aircraft_registry GROUP BY airline)
SELECT ops.airline, CAST(ops.total_flights AS BIGINT) AS total_flights,
  round(ops.total_flight_hours, 6) AS total_flight_hours, CAST(fleet.fleet_size AS BIGINT) AS fleet_size,
  CAST(ops.anomaly_count AS BIGINT) AS anomaly_count,
  round(ops.anomaly_count / ops.total_flights, 6) AS anomaly_rate,
  round(fleet.avg_fleet_age, 6) AS avg_fleet_age,
  round(ops.on_time / ops.total_flights, 6) AS on_time_performance_proxy, top.top_anomaly_type
FROM ops LEFT JOIN fleet ON fleet.airline = ops.airline LEFT JOIN top ON top.airline = ops.airline""")
def airline_operations(spark, d):
    """AG5 + AG6 + JN7 + WN2."""
    return tm.airline_operations(C.flight_summary(spark, d), C.registry(spark, d))
