"""Metric views (MV1-MV6): named dimensions and measures over one table.

A view expands to ``groupBy(dims).agg(measures)`` at whatever grain the
caller asks for (MV4), with an optional filter applied before grouping.
Measures are SQL aggregate expressions (``FILTER (WHERE ...)`` allowed);
their display metadata is attached to the output columns (MV5).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    display_name: str = ""
    fmt: str = "number"  # number | percent | currency
    comment: str = ""


@dataclass(frozen=True)
class MetricView:
    name: str
    dimensions: tuple[str, ...]
    measures: tuple[Measure, ...]
    comment: str = ""
    synonyms: dict = field(default_factory=dict)

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"{self.name} has no measure {name!r}")

    def query(self, source: DataFrame, measures: list[str] | None = None,
              dims: list[str] | None = None, where: str | None = None) -> DataFrame:
        dims = list(dims or [])
        unknown = [d for d in dims if d not in self.dimensions]
        if unknown:
            raise KeyError(f"{self.name} has no dimension(s) {unknown}")
        ms = [self.measure(n) for n in (measures or [m.name for m in self.measures])]
        src = source.filter(F.expr(where)) if where else source
        aggs = [F.expr(m.expr).alias(m.name, metadata={
            "display_name": m.display_name or m.name, "format": m.fmt, "comment": m.comment})
            for m in ms]
        return src.groupBy(*dims).agg(*aggs) if dims else src.agg(*aggs)

    def sql(self, source_sql: str, measures: list[str] | None = None,
            dims: list[str] | None = None, where: str | None = None) -> str:
        """The same expansion as SQL text over ``source_sql`` (used by oracles)."""
        dims = list(dims or [])
        ms = [self.measure(n) for n in (measures or [m.name for m in self.measures])]
        sel = ", ".join(dims + [f"{m.expr} AS {m.name}" for m in ms])
        w = f" WHERE {where}" if where else ""
        g = f" GROUP BY {', '.join(dims)}" if dims else ""
        return f"SELECT {sel} FROM ({source_sql}) src{w}{g}"


# The three published metric views (names, dimensions, measures).
COMPONENT_HEALTH_METRICS = MetricView(
    "component_health_metrics",
    ("airline", "component_type", "criticality", "failure_risk_category", "division",
     "aircraft_type"),
    (Measure("total_components", "COUNT(1)", "Total Components"),
     Measure("avg_health_index", "AVG(health_index)", "Avg Health Index"),
     Measure("critical_risk_components",
             "COUNT(1) FILTER (WHERE failure_risk_category = 'CRITICAL')", "Critical Risk Components"),
     Measure("high_risk_components",
             "COUNT(1) FILTER (WHERE failure_risk_category IN ('CRITICAL', 'HIGH'))",
             "High + Critical Components"),
     Measure("active_anomalies", "COUNT(1) FILTER (WHERE has_active_anomaly = true)",
             "Active Anomalies"),
     Measure("total_warranty_exposure", "SUM(estimated_warranty_exposure_usd)",
             "Total Warranty Exposure", "currency"),
     Measure("avg_days_to_failure", "AVG(days_to_predicted_failure)", "Avg Est. Days to Failure"),
     Measure("avg_compliance_rate", "AVG(maintenance_compliance_rate)",
             "Avg Maintenance Compliance Rate", "percent"),
     Measure("total_anomaly_events", "SUM(anomaly_event_count)", "Total Anomaly Events")),
    comment="Component health, risk and exposure over gold_component_health")

FORECAST_METRICS = MetricView(
    "part_failure_metrics",
    ("airline", "component_type", "criticality", "recommended_action", "risk_decile"),
    (Measure("total_components", "COUNT(1)", "Total Components"),
     Measure("avg_forecast_probability", "AVG(forecast_probability)", "Avg Forecast Probability",
             "percent"),
     Measure("top_decile_components", "COUNT(1) FILTER (WHERE risk_decile = 10)",
             "Top-Decile Components"),
     Measure("proactive_visit_components",
             "COUNT(1) FILTER (WHERE recommended_action = 'PROACTIVE_FIELD_SERVICE_VISIT')",
             "Proactive-Visit Components"),
     Measure("expected_warranty_exposure", "SUM(expected_warranty_exposure_usd)",
             "Expected Warranty Exposure", "currency"),
     Measure("next_quarter_events", "SUM(actual_next_quarter_event)",
             "Actual Events in Forecast Quarter (back-test only)")),
    comment="Next-quarter failure forecast")

ANOMALY_METRICS = MetricView(
    "maintenance_anomaly_metrics",
    ("airline", "component_type", "anomaly_type", "anomaly_severity", "flight_delay_risk",
     "mro_shop", "criticality", "division"),
    (Measure("total_anomalies", "COUNT(1)", "Total Anomalies"),
     Measure("critical_anomalies", "COUNT(1) FILTER (WHERE anomaly_severity = 'CRITICAL')",
             "Critical Anomalies"),
     Measure("high_delay_risk", "COUNT(1) FILTER (WHERE flight_delay_risk IN ('CRITICAL', 'HIGH'))",
             "High Delay Risk Events"),
     Measure("avg_days_undetected", "AVG(days_undetected)", "Avg Days Undetected"),
     Measure("warranty_risk_events", "COUNT(1) FILTER (WHERE warranty_claim_risk = true)",
             "Warranty Risk Events"),
     Measure("total_warranty_exposure", "SUM(record_warranty_exposure_usd)",
             "Total Warranty Exposure", "currency"),
     Measure("overdue_events", "COUNT(1) FILTER (WHERE is_overdue = true)",
             "Overdue Maintenance Events"),
     Measure("avg_overdue_days", "AVG(overdue_days) FILTER (WHERE overdue_days > 0)",
             "Avg Overdue Days")),
    comment="Maintenance anomaly events")

# MV6: fleet operations view over the flight summary (definitions are ours).
FLEET_OPS_METRICS = MetricView(
    "fleet_operations_metrics",
    ("airline", "aircraft_type", "origin", "destination", "anomaly_type", "anomaly_severity"),
    (Measure("flights", "COUNT(1)", "Flight Rows"),
     Measure("anomaly_flights", "COUNT(1) FILTER (WHERE has_anomaly = true)", "Anomalous Flights"),
     Measure("avg_duration_hours", "AVG(flight_duration_hours)", "Avg Duration (h)"),
     Measure("total_fuel_burned", "SUM(total_fuel_burned)", "Fuel Burned"),
     Measure("max_egt", "MAX(greatest(max_egt_eng1, max_egt_eng2))", "Max EGT")),
    comment="Flight operations over gold_flight_summary")
