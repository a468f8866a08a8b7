"""Domain views over the driver tables.

The reference's pipelines read aircraft telemetry, flight metadata,
registries and service records.  The driver ships TPC-H-style tables, so
each domain table is bound to driver columns by one SQL SELECT.  The text
is written in the subset of SQL that Spark and DuckDB both run, so the
DuckDB oracles read exactly the rows the Spark queries read and only the
operator logic is written twice.

Binding (domain <- driver):
  flights            <- orders     (flight_id = o_orderkey, tail = o_custkey)
  telemetry          <- lineitem   (one sensor record per line; label 'R')
  aircraft_registry  <- customer   (tail = c_custkey, airline from nation)
  airlines           <- nation + region (+ fleet size from supplier)
  ib_aircraft        <- supplier   (installed-base aircraft)
  components         <- part       (installed on supplier aircraft)
  maintenance        <- lineitem   (service record of part on supplier)
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wingspan.sources.driver import read_table

# Fixed values of the domain: anomaly type and severity labels, phases.
TELEMETRY_ANOMALY_TYPES = ("EGT_EXCEEDANCE", "VIBRATION_SPIKE", "HYDRAULIC_PRESSURE_DROP")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
RISK_TIERS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
# Fixed date that stands in for "today" (D19: gold tables take an as-of date).
AS_OF_DATE = "2001-08-01"
# Forecast cut-off: history strictly before, label window on or after.
FORECAST_CUTOFF = "2001-01-01"

_AIRLINE = "concat('AL', lpad(CAST({k} AS STRING), 2, '0'))"

BINDINGS: dict[str, tuple[str, tuple[str, ...]]] = {
    "flights": ("""
SELECT o_orderkey AS flight_id,
       o_custkey AS tail_number,
       concat('AP', o_orderstatus) AS origin,
       concat('AP', substr(o_orderpriority, 1, 1)) AS destination,
       o_orderdate AS departure_time,
       o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS has_anomaly
FROM {orders}""", ("orders",)),

    "telemetry": ("""
SELECT l_orderkey AS flight_id,
       l_linenumber AS record_sequence,
       l_shipdate AS event_ts,
       CASE WHEN l_linestatus = 'O' THEN 'CRUISE' ELSE 'CLIMB' END AS flight_phase,
       CASE WHEN l_returnflag = 'R' THEN
            CASE WHEN l_discount < 0.04 THEN 'EGT_EXCEEDANCE'
                 WHEN l_discount < 0.08 THEN 'VIBRATION_SPIKE'
                 ELSE 'HYDRAULIC_PRESSURE_DROP' END END AS anomaly_type,
       CASE WHEN l_returnflag = 'R' THEN
            CASE WHEN l_tax >= 0.06 THEN 'CRITICAL' WHEN l_tax >= 0.04 THEN 'HIGH'
                 WHEN l_tax >= 0.02 THEN 'MEDIUM' ELSE 'LOW' END END AS anomaly_severity,
       l_quantity * 700.0 AS altitude,
       150.0 + l_quantity * 6.0 AS indicated_airspeed,
       500.0 + l_extendedprice / 250.0 AS egt_eng1,
       500.0 + l_extendedprice / 250.0 + l_tax * 1000.0 AS egt_eng2,
       l_discount * 40.0 AS vibration_n1_eng1,
       l_tax * 40.0 AS vibration_n1_eng2,
       (l_discount + l_tax) * 20.0 AS vibration_n2_eng1,
       l_quantity / 20.0 AS vibration_n2_eng2,
       l_extendedprice / 50.0 AS fuel_flow_eng1,
       l_quantity * 40.0 AS fuel_flow_eng2,
       40.0 + l_quantity AS oil_pressure_eng1,
       45.0 - l_quantity AS oil_pressure_eng2,
       2800.0 + l_quantity * 10.0 AS hyd_press_sys1,
       3000.0 - l_discount * 2000.0 AS hyd_press_sys2,
       2900.0 + l_tax * 1000.0 AS hyd_press_sys3
FROM {lineitem}""", ("lineitem",)),

    "aircraft_registry": (f"""
SELECT c_custkey AS tail_number,
       {_AIRLINE.format(k='c_nationkey')} AS airline,
       c_mktsegment AS aircraft_type,
       CAST(floor((c_acctbal + 1000.0) / 550.0) AS INT) AS aircraft_age_years,
       c_acctbal + 1000.0 AS total_flight_hours,
       DATE '2001-06-01' - CAST(c_custkey % 400 AS INT) AS last_maintenance_date,
       DATE '2001-06-01' + CAST(c_custkey % 180 AS INT) AS next_scheduled_maintenance
FROM {{customer}}""", ("customer",)),

    "airlines": (f"""
SELECT {_AIRLINE.format(k='n.n_nationkey')} AS airline,
       r.r_name AS hub,
       coalesce(f.fleet_size, 0) AS fleet_size
FROM {{nation}} n
JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT s_nationkey, count(*) AS fleet_size FROM {{supplier}} GROUP BY s_nationkey) f
  ON f.s_nationkey = n.n_nationkey""", ("nation", "region", "supplier")),

    "ib_aircraft": (f"""
SELECT s_suppkey AS tail_number,
       {_AIRLINE.format(k='s_nationkey')} AS airline,
       CASE s_suppkey % 3 WHEN 0 THEN 'A320' WHEN 1 THEN 'B737' ELSE 'E175' END AS aircraft_type,
       CAST(floor((s_acctbal + 1000.0) / 550.0) AS BIGINT) AS age_years,
       2001 - CAST(floor((s_acctbal + 1000.0) / 550.0) AS BIGINT) AS manufacture_year,
       CAST(floor((s_acctbal + 1000.0) * 5.0) AS BIGINT) AS total_flight_hours,
       CAST(floor((s_acctbal + 1000.0) * 3.0) AS BIGINT) AS total_cycles
FROM {{supplier}}""", ("supplier",)),

    "components": (f"""
SELECT p.p_partkey AS component_id,
       p.p_type AS component_type,
       p.p_name AS description,
       p.p_brand AS division,
       s.s_suppkey AS tail_number,
       {_AIRLINE.format(k='s.s_nationkey')} AS airline,
       CASE s.s_suppkey % 3 WHEN 0 THEN 'A320' WHEN 1 THEN 'B737' ELSE 'E175' END AS aircraft_type,
       CASE WHEN CAST(substr(p.p_brand, 7) AS INT) <= 10 THEN 'FLIGHT_CRITICAL'
            ELSE 'ESSENTIAL' END AS criticality,
       DATE '1998-01-01' - CAST(p.p_partkey % 900 AS INT) AS install_date,
       CAST(p.p_size * 5 AS BIGINT) AS maintenance_interval_days,
       CAST(floor(p.p_retailprice * 20.0) AS BIGINT) AS max_cycles,
       CAST((p.p_partkey * 37) % 21000 AS BIGINT) AS cycles_since_install,
       CAST(floor(p.p_retailprice * 15.0) AS BIGINT) AS unit_cost_usd
FROM {{part}} p
JOIN {{supplier}} s ON s.s_suppkey = p.p_partkey % (SELECT count(*) FROM {{supplier}})""",
                   ("part", "supplier")),

    "maintenance": ("""
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS record_id,
       l_partkey AS component_id,
       l_suppkey AS tail_number,
       CAST(l_shipdate AS DATE) AS maintenance_date,
       CASE WHEN l_linestatus = 'O' THEN 'SCHEDULED' ELSE 'UNSCHEDULED' END AS maintenance_type,
       concat('MRO-', CAST(l_linenumber AS STRING)) AS mro_shop,
       CAST(floor(l_extendedprice / 10.0) AS BIGINT) AS cycles_at_service,
       CAST(floor(l_quantity * 5.0) AS BIGINT) AS days_since_last_service,
       l_quantity * 5.0 > 140.0 AS is_overdue,
       CASE WHEN l_returnflag = 'R' THEN 'NON_COMPLIANT' ELSE 'COMPLIANT' END AS compliance_status,
       l_returnflag = 'R' AS anomaly_flag,
       CASE WHEN l_returnflag = 'R' THEN
            CASE WHEN l_discount < 0.02 THEN 'SEAL_LEAK' WHEN l_discount < 0.04 THEN 'PRESSURE_DRIFT'
                 WHEN l_discount < 0.06 THEN 'VALVE_STICTION' WHEN l_discount < 0.08 THEN 'SENSOR_FAULT'
                 WHEN l_discount < 0.10 THEN 'OVERHEAT' ELSE 'CONTAMINATION' END END AS anomaly_type,
       CASE WHEN l_returnflag = 'R' AND l_tax > 0.0 THEN
            CASE WHEN l_tax >= 0.06 THEN 'CRITICAL' WHEN l_tax >= 0.04 THEN 'HIGH'
                 WHEN l_tax >= 0.02 THEN 'MEDIUM' ELSE 'LOW' END END AS anomaly_severity,
       l_returnflag = 'R' AND l_discount >= 0.07 AS warranty_claim_risk,
       CASE WHEN l_tax >= 0.07 THEN 'CRITICAL' WHEN l_tax >= 0.05 THEN 'HIGH'
            WHEN l_tax >= 0.03 THEN 'MEDIUM' ELSE 'LOW' END AS flight_delay_risk,
       CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice / 1000.0) AS BIGINT) END
            AS days_undetected
FROM {lineitem}""", ("lineitem",)),
}


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The domain view ``name`` as a lazy DataFrame over ``sf_dir``."""
    sql, tables = BINDINGS[name]
    frames = {t: read_table(spark, sf_dir, t) for t in tables}
    return spark.sql(sql, **frames)


def bound_sql(name: str) -> str:
    """Binding text with plain table names (DuckDB oracle form)."""
    sql, _ = BINDINGS[name]
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def oracle_prelude(*names: str) -> str:
    """``WITH`` clause that defines the given domain views for an oracle query."""
    parts = [f"{n} AS ({bound_sql(n)}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
