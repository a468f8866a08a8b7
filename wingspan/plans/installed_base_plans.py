"""Installed-base queries: service records to component / airline tables."""

from __future__ import annotations

from wingspan.operators import installed_base as ib
from wingspan.plans import common as C
from wingspan.plans.registry import query
from wingspan.sources.bindings import AS_OF_DATE

G = "installed_base"


@query("enriched_maintenance", group=G, oracle=C.IB_PRE + """
SELECT record_id, component_id, tail_number, maintenance_date, maintenance_type, mro_shop,
  cycles_at_service, days_since_last_service, is_overdue, compliance_status, anomaly_flag,
  anomaly_type, anomaly_severity, warranty_claim_risk, flight_delay_risk, days_undetected,
  component_type, description, division, maintenance_interval_days, max_cycles,
  unit_cost_usd, criticality, airline, aircraft_type, manufacture_year, age_years,
  total_flight_hours, overdue_days, round(compliance_score, 6) AS compliance_score,
  anomaly_risk_flag, record_warranty_exposure_usd
FROM em""")
def enriched_maintenance(spark, d):
    """JN3 + SC2-SC5 + PRJ3 (silver enriched maintenance)."""
    return C.enriched_maintenance(spark, d)


@query("health_snapshot", group=G, oracle=C.IB_PRE + """
SELECT component_id, component_type, tail_number, airline, aircraft_type, reading_date,
  round(health_index, 6) AS health_index,
  round(maintenance_compliance_rate, 6) AS maintenance_compliance_rate, cycles_since_install,
  days_since_last_service, days_until_next_service, days_to_predicted_failure,
  failure_risk_category, has_active_anomaly, latest_anomaly_type, estimated_warranty_exposure_usd
FROM snap""")
def health_snapshot(spark, d):
    """SC7-SC9 + WN8 + AG30: component health reading as of the fixed date."""
    return C.snapshot(spark, d)


@query("component_health", group=G, oracle=C.IB_PRE + """
, hist AS (SELECT component_id, count(*) AS total_service_events,
    sum(CASE WHEN compliance_status = 'COMPLIANT' THEN 1 ELSE 0 END) AS compliant_events,
    sum(CASE WHEN anomaly_flag THEN 1 ELSE 0 END) AS anomaly_event_count,
    sum(record_warranty_exposure_usd) AS total_warranty_exposure_usd,
    max(maintenance_date) AS last_service_date
  FROM em GROUP BY component_id)
SELECT s.component_id, s.component_type, s.tail_number, s.airline, s.aircraft_type,
  c.description, c.division, c.criticality, c.unit_cost_usd,
  round(s.health_index, 6) AS health_index, s.cycles_since_install, s.days_since_last_service,
  s.days_until_next_service, s.days_to_predicted_failure,
  round(s.maintenance_compliance_rate, 6) AS maintenance_compliance_rate, s.failure_risk_category,
  s.has_active_anomaly, s.latest_anomaly_type, s.estimated_warranty_exposure_usd, s.reading_date,
  CAST(h.total_service_events AS BIGINT) AS total_service_events,
  CAST(h.compliant_events AS BIGINT) AS compliant_events,
  CAST(h.anomaly_event_count AS BIGINT) AS anomaly_event_count,
  CAST(h.total_warranty_exposure_usd AS BIGINT) AS total_warranty_exposure_usd, h.last_service_date
FROM snap s LEFT JOIN comp c ON c.component_id = s.component_id
LEFT JOIN hist h ON h.component_id = s.component_id""")
def component_health(spark, d):
    """Gold component scorecard (JN8 + AG8)."""
    recs, comps = C.records(spark, d), C.components(spark, d)
    stats = ib.service_stats_with_as_of(recs, AS_OF_DATE)   # one pass, used twice
    snap = ib.bronze(ib.health_snapshot(comps, recs, AS_OF_DATE, stats), ib.SNAPSHOT_RULES)
    return ib.component_health(snap, comps, recs, stats)


@query("maintenance_compliance", group=G, oracle=C.IB_PRE + """
SELECT airline, component_type, criticality, CAST(count(*) AS BIGINT) AS total_records,
  round(avg(compliance_score), 6) AS avg_compliance_score,
  CAST(sum(CASE WHEN compliance_status = 'COMPLIANT' THEN 1 ELSE 0 END) AS BIGINT) AS compliant_count,
  CAST(sum(CASE WHEN anomaly_flag THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  CAST(sum(CASE WHEN warranty_claim_risk THEN 1 ELSE 0 END) AS BIGINT) AS warranty_risk_count,
  CAST(sum(record_warranty_exposure_usd) AS BIGINT) AS total_warranty_exposure_usd,
  round(avg(overdue_days), 6) AS avg_overdue_days,
  CAST(max(overdue_days) AS BIGINT) AS max_overdue_days,
  round(sum(CASE WHEN compliance_status = 'COMPLIANT' THEN 1 ELSE 0 END) / count(*), 6)
    AS compliance_rate,
  CASE WHEN avg(compliance_score) < 0.80 THEN 'HIGH' WHEN avg(compliance_score) < 0.90 THEN 'MEDIUM'
       ELSE 'LOW' END AS sla_breach_risk
FROM em GROUP BY airline, component_type, criticality""")
def maintenance_compliance(spark, d):
    """AG9 + SC6."""
    return ib.maintenance_compliance(C.enriched_maintenance(spark, d))


@query("maintenance_anomalies", group=G, oracle=C.IB_PRE + f"""
SELECT {", ".join(ib.ANOMALY_DETAIL_COLS)} FROM em WHERE anomaly_flag""")
def maintenance_anomalies(spark, d):
    """FLT2: anomalous service records with context."""
    return ib.maintenance_anomalies(C.enriched_maintenance(spark, d))


@query("customer_operations", group=G, oracle=C.IB_PRE + """
, ms AS (SELECT airline, count(*) AS total_maintenance_events, avg(compliance_score) AS compliance_rate,
    sum(CASE WHEN anomaly_flag THEN 1 ELSE 0 END) AS total_anomalies,
    sum(CASE WHEN warranty_claim_risk THEN 1 ELSE 0 END) AS warranty_risk_events,
    sum(record_warranty_exposure_usd) AS total_warranty_exposure_usd,
    count(DISTINCT component_id) AS components_serviced
  FROM em GROUP BY airline)
, cr AS (SELECT airline, count(*) AS critical_components FROM snap
         WHERE failure_risk_category = 'CRITICAL' GROUP BY airline)
, tc AS (SELECT airline, anomaly_type, count(*) AS cnt FROM em WHERE anomaly_flag
         GROUP BY airline, anomaly_type)
, top AS (SELECT airline, anomaly_type AS top_anomaly_type FROM (SELECT *, row_number() OVER (
          PARTITION BY airline ORDER BY cnt DESC, anomaly_type) AS rn FROM tc) WHERE rn = 1)
SELECT al.airline, al.hub, al.fleet_size, CAST(ms.total_maintenance_events AS BIGINT)
    AS total_maintenance_events, round(ms.compliance_rate, 6) AS compliance_rate,
  CAST(ms.total_anomalies AS BIGINT) AS total_anomalies,
  CAST(ms.warranty_risk_events AS BIGINT) AS warranty_risk_events,
  CAST(ms.total_warranty_exposure_usd AS BIGINT) AS total_warranty_exposure_usd,
  CAST(ms.components_serviced AS BIGINT) AS components_serviced,
  CAST(coalesce(cr.critical_components, 0) AS BIGINT) AS critical_components, top.top_anomaly_type
FROM al LEFT JOIN ms ON ms.airline = al.airline LEFT JOIN cr ON cr.airline = al.airline
LEFT JOIN top ON top.airline = al.airline""")
def customer_operations(spark, d):
    """AG10 + AG11 + WN3 + JN9 (dimension-preserving, default fill)."""
    return ib.customer_operations(C.airlines(spark, d), C.enriched_maintenance(spark, d),
                                  C.snapshot(spark, d))


@query("service_gap", group=G, oracle=C.IB_PRE + """
, g AS (SELECT r.record_id, r.component_id, r.maintenance_date, c.maintenance_interval_days,
    coalesce(date_diff('day', lag(r.maintenance_date) OVER (PARTITION BY r.component_id
             ORDER BY r.maintenance_date, r.record_id), r.maintenance_date),
             date_diff('day', c.install_date, r.maintenance_date)) AS gap_days
  FROM rec r LEFT JOIN comp c ON c.component_id = r.component_id)
SELECT record_id, component_id, maintenance_date, CAST(gap_days AS BIGINT) AS gap_days,
  CAST(greatest(gap_days - maintenance_interval_days, 0) AS BIGINT) AS overdue_days,
  gap_days > maintenance_interval_days + 14 AS overdue_with_grace
FROM g""")
def service_gap(spark, d):
    """WN6 + SC3/SC4 (D8: the two overdue rules side by side)."""
    return ib.service_gaps(C.records(spark, d), C.components(spark, d))
