"""Metric-view queries (MV1-MV6) and the metric validation check (DQ9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.operators import metrics as mv
from wingspan.plans.registry import all_oracles, all_queries, query

G = "metrics"


def _src(spark, d, name):
    # metric views read the published (rounded) gold tables
    return all_queries()[name](spark, d)


def _osrc(name):
    return all_oracles()[name]


def _oracle(view, src, dims, rnd=()):
    inner = view.sql(_osrc(src), dims=dims)
    cols = dims + [m.name for m in view.measures]
    outer = ", ".join(f"round({c}, 6) AS {c}" if c in rnd else
                      (f"CAST({c} AS BIGINT) AS {c}" if c not in dims else c) for c in cols)
    return f"SELECT {outer} FROM ({inner}) q"


_CH_DIMS = ["airline", "failure_risk_category"]
_CH_DBL = ("avg_health_index", "avg_days_to_failure", "avg_compliance_rate")


@query("mv_component_health", group=G, oracle=_oracle(
    mv.COMPONENT_HEALTH_METRICS, "component_health", _CH_DIMS, _CH_DBL))
def mv_component_health(spark, d):
    """MV1 + MV4 at (airline, risk tier) grain."""
    out = mv.COMPONENT_HEALTH_METRICS.query(_src(spark, d, "component_health"), dims=_CH_DIMS)
    return out.withColumns({m.name: F.col(m.name).cast("bigint")
                            for m in mv.COMPONENT_HEALTH_METRICS.measures
                            if m.name not in _CH_DBL})


_FC_DIMS = ["recommended_action"]
_FC_DBL = ("avg_forecast_probability", "expected_warranty_exposure")


@query("mv_forecast", group=G, oracle=_oracle(mv.FORECAST_METRICS, "forecast_table", _FC_DIMS,
                                              _FC_DBL))
def mv_forecast(spark, d):
    """MV2 at recommended-action grain."""
    out = mv.FORECAST_METRICS.query(_src(spark, d, "forecast_table"), dims=_FC_DIMS)
    return out.withColumns({m.name: F.col(m.name).cast("bigint") for m in mv.FORECAST_METRICS.measures
                            if m.name not in _FC_DBL})


_AN_DIMS = ["anomaly_type", "anomaly_severity"]
_AN_DBL = ("avg_days_undetected", "avg_overdue_days")


@query("mv_anomaly", group=G, oracle=_oracle(mv.ANOMALY_METRICS, "maintenance_anomalies", _AN_DIMS,
                                             _AN_DBL))
def mv_anomaly(spark, d):
    """MV3 at (type, severity) grain."""
    out = mv.ANOMALY_METRICS.query(_src(spark, d, "maintenance_anomalies"), dims=_AN_DIMS)
    return out.withColumns({m.name: F.col(m.name).cast("bigint") for m in mv.ANOMALY_METRICS.measures
                            if m.name not in _AN_DBL})


_FO_DIMS = ["airline"]
_FO_DBL = ("avg_duration_hours", "total_fuel_burned", "max_egt")


@query("mv_fleet_ops", group=G, oracle=_oracle(mv.FLEET_OPS_METRICS, "flight_summary", _FO_DIMS,
                                               _FO_DBL))
def mv_fleet_ops(spark, d):
    """MV6 over the flight summary."""
    out = mv.FLEET_OPS_METRICS.query(_src(spark, d, "flight_summary"), dims=_FO_DIMS)
    return out.withColumns({m.name: F.col(m.name).cast("bigint") for m in mv.FLEET_OPS_METRICS.measures
                            if m.name not in _FO_DBL})


def _validation_oracle():
    ch = mv.COMPONENT_HEALTH_METRICS.sql(_osrc("component_health"), ["total_components"])
    fc = mv.FORECAST_METRICS.sql(_osrc("forecast_table"),
                                 ["total_components", "proactive_visit_components",
                                  "top_decile_components"])
    an = mv.ANOMALY_METRICS.sql(_osrc("maintenance_anomalies"), ["total_anomalies"])
    return f"""
SELECT metric_view, measure_name, CAST(actual AS BIGINT) AS actual,
  CAST(expected AS BIGINT) AS expected, actual = expected AS pass FROM (
  SELECT 1 AS o, 'component_health_metrics' AS metric_view, 'total_components' AS measure_name,
    (SELECT total_components FROM ({ch})) AS actual,
    (SELECT count(*) FROM ({_osrc('health_snapshot')})) AS expected
  UNION ALL SELECT 2, 'part_failure_metrics', 'total_components',
    (SELECT total_components FROM ({fc})), (SELECT count(*) FROM ({_osrc('pit_features')}))
  UNION ALL SELECT 3, 'part_failure_metrics', 'proactive_visit_components',
    (SELECT proactive_visit_components FROM ({fc})), (SELECT top_decile_components FROM ({fc}))
  UNION ALL SELECT 4, 'maintenance_anomaly_metrics', 'total_anomalies',
    (SELECT total_anomalies FROM ({an})),
    (SELECT count(*) FROM ({_osrc('enriched_maintenance')}) WHERE anomaly_flag)) q"""


@query("mv_validation", group=G, oracle=_validation_oracle())
def mv_validation(spark, d):
    """DQ9 / MV4: metric values checked against independent counts, assert_true in plan.

    Fails the job (naming the check) if a measure differs from its count.
    """
    ch = mv.COMPONENT_HEALTH_METRICS.query(_src(spark, d, "component_health"), ["total_components"])
    fc = mv.FORECAST_METRICS.query(_src(spark, d, "forecast_table"),
                                   ["total_components", "proactive_visit_components",
                                    "top_decile_components"])
    an = mv.ANOMALY_METRICS.query(_src(spark, d, "maintenance_anomalies"), ["total_anomalies"])
    snap_n = _src(spark, d, "health_snapshot").select(F.count(F.lit(1))).scalar()
    pit_n = _src(spark, d, "pit_features").select(F.count(F.lit(1))).scalar()
    anom_n = (_src(spark, d, "enriched_maintenance").filter("anomaly_flag")
              .select(F.count(F.lit(1))).scalar())

    def check(view, measure, actual_df, col, expected):
        return actual_df.select(F.lit(view).alias("metric_view"), F.lit(measure).alias("measure_name"),
                                F.col(col).cast("bigint").alias("actual"),
                                expected.cast("bigint").alias("expected"))
    rows = (check("component_health_metrics", "total_components", ch, "total_components", snap_n)
            .unionByName(check("part_failure_metrics", "total_components", fc, "total_components",
                               pit_n))
            .unionByName(check("part_failure_metrics", "proactive_visit_components", fc,
                               "proactive_visit_components", F.col("top_decile_components")))
            .unionByName(check("maintenance_anomaly_metrics", "total_anomalies", an,
                               "total_anomalies", anom_n)))
    pass_ = F.col("actual") == F.col("expected")
    msg = F.concat(F.lit("Validation failed: "), F.col("metric_view"), F.lit("."),
                   F.col("measure_name"), F.lit(" = "), F.col("actual").cast("string"),
                   F.lit(", expected "), F.col("expected").cast("string"))
    return (rows.withColumn("pass", pass_)
            .filter(F.assert_true(pass_, msg).isNull()))
