"""Shared inputs of the plan modules (bound views with bronze rules applied)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wingspan.operators import installed_base as ib
from wingspan.operators import telemetry as tm
from wingspan.sources.bindings import AS_OF_DATE, bound, oracle_prelude

SENSORS = ["altitude", "indicated_airspeed", "egt_eng1", "egt_eng2", "vibration_n1_eng1",
           "vibration_n1_eng2", "vibration_n2_eng1", "vibration_n2_eng2", "fuel_flow_eng1",
           "fuel_flow_eng2", "oil_pressure_eng1", "oil_pressure_eng2", "hyd_press_sys1",
           "hyd_press_sys2", "hyd_press_sys3"]


def telemetry(spark: SparkSession, d: str) -> DataFrame:
    return tm.bronze_telemetry(bound(spark, d, "telemetry"))


def flights(spark: SparkSession, d: str) -> DataFrame:
    return bound(spark, d, "flights")


def registry(spark: SparkSession, d: str) -> DataFrame:
    return bound(spark, d, "aircraft_registry")


def enriched_telemetry(spark: SparkSession, d: str) -> DataFrame:
    return tm.enrich_telemetry(telemetry(spark, d), flights(spark, d), registry(spark, d))


def flight_summary(spark: SparkSession, d: str) -> DataFrame:
    return tm.flight_summary(telemetry(spark, d), flights(spark, d), registry(spark, d))


def records(spark: SparkSession, d: str) -> DataFrame:
    return ib.bronze(bound(spark, d, "maintenance"), ib.RECORD_RULES)


def components(spark: SparkSession, d: str) -> DataFrame:
    return ib.bronze(bound(spark, d, "components"), ib.COMPONENT_RULES)


def ib_aircraft(spark: SparkSession, d: str) -> DataFrame:
    return ib.bronze(bound(spark, d, "ib_aircraft"), ib.AIRCRAFT_RULES)


def airlines(spark: SparkSession, d: str) -> DataFrame:
    return ib.bronze(bound(spark, d, "airlines"), ib.AIRLINE_RULES)


def enriched_maintenance(spark: SparkSession, d: str) -> DataFrame:
    return ib.enrich_maintenance(records(spark, d), components(spark, d), ib_aircraft(spark, d))


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    return ib.bronze(ib.health_snapshot(components(spark, d), records(spark, d), AS_OF_DATE),
                     ib.SNAPSHOT_RULES)


# ---------------------------------------------------------------- oracle CTEs
# DuckDB text of the same inputs (bronze rules applied), reused by oracles.
TEL_CLEAN = """clean AS (SELECT * FROM telemetry WHERE event_ts IS NOT NULL AND flight_id IS NOT NULL
  AND altitude >= 0 AND oil_pressure_eng1 >= 0 AND oil_pressure_eng2 >= 0)"""
ENRICHED = """enriched AS (SELECT t.*, f.tail_number, f.origin, f.destination, f.departure_time,
  f.has_anomaly, r.airline, r.aircraft_type, r.aircraft_age_years, r.total_flight_hours,
  r.last_maintenance_date, r.next_scheduled_maintenance,
  (t.egt_eng1 + t.egt_eng2) / 2 AS engine_avg_egt,
  (t.vibration_n1_eng1 + t.vibration_n1_eng2 + t.vibration_n2_eng1 + t.vibration_n2_eng2) / 4
    AS engine_avg_vibration,
  t.fuel_flow_eng1 + t.fuel_flow_eng2 AS fuel_burn_rate,
  (least(t.hyd_press_sys1, t.hyd_press_sys2, t.hyd_press_sys3) - 2600.0) / 600.0
    AS hydraulic_health_index
  FROM clean t LEFT JOIN flights f ON f.flight_id = t.flight_id
  LEFT JOIN aircraft_registry r ON r.tail_number = f.tail_number)"""
FLIGHT_SUMMARY = """fs AS (SELECT flight_id, airline, aircraft_type, tail_number, origin, destination,
  departure_time, has_anomaly, anomaly_type, anomaly_severity,
  date_diff('second', min(event_ts), max(event_ts)) / 3600.0 AS flight_duration_hours,
  max(altitude) AS max_altitude,
  avg(CASE WHEN flight_phase = 'CRUISE' THEN indicated_airspeed END) AS avg_cruise_speed,
  sum(fuel_burn_rate) AS total_fuel_burned,
  max(egt_eng1) AS max_egt_eng1, max(egt_eng2) AS max_egt_eng2,
  greatest(max(vibration_n1_eng1), max(vibration_n1_eng2), max(vibration_n2_eng1),
           max(vibration_n2_eng2)) AS max_vibration,
  avg(oil_pressure_eng1) AS avg_oil_pressure_eng1, avg(oil_pressure_eng2) AS avg_oil_pressure_eng2,
  min(least(hyd_press_sys1, hyd_press_sys2, hyd_press_sys3)) AS min_hydraulic_pressure,
  CAST(count(CASE WHEN anomaly_type IS NOT NULL THEN 1 END) AS BIGINT) AS anomaly_record_count
  FROM enriched
  GROUP BY flight_id, airline, aircraft_type, tail_number, origin, destination, departure_time,
           has_anomaly, anomaly_type, anomaly_severity)"""
TEL_PRE = oracle_prelude("telemetry", "flights", "aircraft_registry") + ", " + TEL_CLEAN + \
    ",\n" + ENRICHED + ",\n" + FLIGHT_SUMMARY + "\n"

IB_RECORDS = """rec AS MATERIALIZED (SELECT * FROM maintenance WHERE record_id IS NOT NULL
  AND component_id IS NOT NULL AND maintenance_date IS NOT NULL),
comp AS (SELECT * FROM components WHERE component_id IS NOT NULL AND component_type IS NOT NULL
  AND cycles_since_install >= 0),
ac AS (SELECT * FROM ib_aircraft WHERE tail_number IS NOT NULL AND airline IS NOT NULL),
al AS (SELECT * FROM airlines WHERE airline IS NOT NULL),
em AS MATERIALIZED (SELECT m.record_id, m.component_id, m.tail_number, m.maintenance_date, m.maintenance_type,
  m.mro_shop, m.cycles_at_service, m.days_since_last_service, m.is_overdue, m.compliance_status,
  m.anomaly_flag, m.anomaly_type, m.anomaly_severity, m.warranty_claim_risk, m.flight_delay_risk,
  m.days_undetected, c.component_type, c.description, c.division,
  c.maintenance_interval_days, c.max_cycles, c.unit_cost_usd, c.criticality,
  a.airline, a.aircraft_type, a.manufacture_year, a.age_years, a.total_flight_hours,
  CAST(greatest(m.days_since_last_service - c.maintenance_interval_days, 0) AS BIGINT) AS overdue_days,
  CASE WHEN m.compliance_status = 'COMPLIANT' THEN 1.0 - least(CAST(m.days_since_last_service AS DOUBLE)
       / (c.maintenance_interval_days * 1.5), 1.0) * 0.2 ELSE 0.0 END AS compliance_score,
  m.anomaly_flag AND m.anomaly_severity IN ('HIGH', 'CRITICAL') AS anomaly_risk_flag,
  CAST(CASE WHEN m.warranty_claim_risk THEN c.unit_cost_usd ELSE 0 END AS BIGINT)
    AS record_warranty_exposure_usd
  FROM rec m LEFT JOIN comp c ON c.component_id = m.component_id
  LEFT JOIN ac a ON a.tail_number = m.tail_number),
latest AS (SELECT component_id, anomaly_flag AS latest_anomaly_flag, anomaly_type AS latest_type
  FROM (SELECT *, row_number() OVER (PARTITION BY component_id ORDER BY maintenance_date DESC,
        record_id DESC, anomaly_flag DESC, anomaly_type DESC NULLS LAST) AS rn
        FROM rec WHERE maintenance_date <= DATE '2001-08-01') WHERE rn = 1),
sst AS (SELECT component_id, count(*) AS n,
  sum(CASE WHEN compliance_status = 'COMPLIANT' THEN 1 ELSE 0 END) AS compliant_events,
  max(maintenance_date) AS last_service_date
  FROM rec WHERE maintenance_date <= DATE '2001-08-01' GROUP BY component_id),
snap0 AS (SELECT c.*, s.n, s.compliant_events, l.latest_anomaly_flag, l.latest_type,
  date_diff('day', coalesce(s.last_service_date, c.install_date), DATE '2001-08-01') AS dsls
  FROM comp c LEFT JOIN sst s ON s.component_id = c.component_id
  LEFT JOIN latest l ON l.component_id = c.component_id),
snap1 AS (SELECT *, least(greatest(100.0
    - coalesce(least(CAST(cycles_since_install AS DOUBLE) / max_cycles, 1.0), 1.0) * 45.0
    - coalesce(least(CAST(dsls AS DOUBLE) / maintenance_interval_days, 1.5), 1.5) * 35.0, 0.0), 100.0)
    AS health_index,
  CAST(dsls AS DOUBLE) / maintenance_interval_days AS late FROM snap0),
snap2 AS (SELECT *, CASE WHEN health_index < 30 OR late > 1.5 THEN 'CRITICAL'
  WHEN health_index < 50 OR late > 1.2 THEN 'HIGH' WHEN health_index < 70 OR late > 1.0 THEN 'MEDIUM'
  ELSE 'LOW' END AS failure_risk_category FROM snap1),
snap AS MATERIALIZED (SELECT component_id, component_type, tail_number, airline, aircraft_type,
  DATE '2001-08-01' AS reading_date, health_index,
  coalesce(compliant_events, 0) / greatest(coalesce(n, 0), 1) AS maintenance_compliance_rate,
  cycles_since_install, CAST(dsls AS BIGINT) AS days_since_last_service,
  CAST(greatest(maintenance_interval_days - dsls, 0) AS BIGINT) AS days_until_next_service,
  CAST(floor(health_index * maintenance_interval_days / 50.0) AS BIGINT) AS days_to_predicted_failure,
  failure_risk_category, coalesce(latest_anomaly_flag, false) AS has_active_anomaly,
  CASE WHEN latest_anomaly_flag THEN latest_type END AS latest_anomaly_type,
  CAST(CASE WHEN failure_risk_category IN ('CRITICAL', 'HIGH') THEN unit_cost_usd ELSE 0 END AS BIGINT)
    AS estimated_warranty_exposure_usd
  FROM snap2 WHERE health_index BETWEEN 0 AND 100
  AND failure_risk_category IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL'))"""
IB_PRE = oracle_prelude("maintenance", "components", "ib_aircraft", "airlines") + ", " + \
    IB_RECORDS + "\n"
