"""Named reports and KPI queries (NQ1-NQ8, AG15-AG31, SO1-SO8, SRC16, JN20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.functions import scoring
from wingspan.functions.columns import flag_count
from wingspan.plans import common as C
from wingspan.plans.feature_plans import PIT_PRE, forecast
from wingspan.plans.registry import all_oracles, all_queries, query

G = "reports"


def _q(spark, d, name):
    return all_queries()[name](spark, d)


def _o(name):
    return all_oracles()[name]


@query("monthly_trend", group=G, oracle=C.TEL_PRE + """
SELECT airline, CAST(date_trunc('month', departure_time) AS DATE) AS month,
  CAST(count(*) AS BIGINT) AS flights,
  CAST(sum(CASE WHEN has_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomalies,
  round(avg(CASE WHEN has_anomaly THEN 1 ELSE 0 END) * 100, 1) AS anomaly_pct
FROM fs GROUP BY ALL""")
def monthly_trend(spark, d):
    """AG21: (airline, month) flights, anomalies and percentage (SF5 round to 1)."""
    fs = C.flight_summary(spark, d)
    return fs.groupBy("airline", F.to_date(F.date_trunc("month", "departure_time")).alias("month")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("flights"),
             flag_count(F.col("has_anomaly")).alias("anomalies"),
             F.round(F.avg(F.when(F.col("has_anomaly"), 1).otherwise(0)) * 100, 1).alias("anomaly_pct"))


@query("phase_distribution", group=G, oracle=C.TEL_PRE + """
SELECT flight_phase, anomaly_severity, CAST(count(*) AS BIGINT) AS n FROM enriched
WHERE anomaly_type IS NOT NULL GROUP BY ALL""")
def phase_distribution(spark, d):
    """AG22: anomalous records by phase and severity."""
    return (C.enriched_telemetry(spark, d).filter(F.col("anomaly_type").isNotNull())
            .groupBy("flight_phase", "anomaly_severity").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@query("airline_anomaly_pct", group=G, oracle=C.TEL_PRE + """
SELECT airline, CAST(count(*) AS BIGINT) AS flights,
  CAST(sum(CASE WHEN has_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomalies,
  round(avg(CASE WHEN has_anomaly THEN 1 ELSE 0 END) * 100, 1) AS anomaly_pct
FROM fs GROUP BY airline""")
def airline_anomaly_pct(spark, d):
    """AG23 (sorted by pct desc in the reference; order is presentation)."""
    fs = C.flight_summary(spark, d)
    return fs.groupBy("airline").agg(
        F.count(F.lit(1)).cast("bigint").alias("flights"), flag_count(F.col("has_anomaly")).alias("anomalies"),
        F.round(F.avg(F.when(F.col("has_anomaly"), 1).otherwise(0)) * 100, 1).alias("anomaly_pct"))


@query("age_profile", group=G, oracle=C.TEL_PRE + """
SELECT airline, round(avg(aircraft_age_years), 1) AS avg_age, CAST(count(*) AS BIGINT) AS aircraft
FROM aircraft_registry GROUP BY airline""")
def age_profile(spark, d):
    """AG24."""
    return C.registry(spark, d).groupBy("airline").agg(
        F.round(F.avg("aircraft_age_years"), 1).alias("avg_age"),
        F.count(F.lit(1)).cast("bigint").alias("aircraft"))


@query("worst_operators", group=G, oracle=C.IB_PRE + """
SELECT airline, round(avg(CAST(anomaly_flag AS INT)) * 100, 1) AS anomaly_pct,
  round(avg(CAST(is_overdue AS INT)) * 100, 1) AS overdue_pct, CAST(count(*) AS BIGINT) AS records
FROM em GROUP BY airline ORDER BY avg(CAST(anomaly_flag AS INT)) DESC, airline LIMIT 3""")
def worst_operators(spark, d):
    """NQ6 / SO5: three operators with the highest anomaly rate (top-k is the feature)."""
    em = C.enriched_maintenance(spark, d)
    g = em.groupBy("airline").agg(F.avg(F.col("anomaly_flag").cast("int")).alias("_r"),
                                  F.avg(F.col("is_overdue").cast("int")).alias("_o"),
                                  F.count(F.lit(1)).cast("bigint").alias("records"))
    return g.orderBy(F.col("_r").desc(), "airline").limit(3).select(
        "airline", F.round(F.col("_r") * 100, 1).alias("anomaly_pct"),
        F.round(F.col("_o") * 100, 1).alias("overdue_pct"), "records")


@query("kpi_base", group=G, oracle=C.IB_PRE + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM snap) AS components,
  (SELECT CAST(count(DISTINCT airline) AS BIGINT) FROM snap) AS operators,
  (SELECT CAST(count(DISTINCT tail_number) AS BIGINT) FROM snap) AS aircraft,
  (SELECT CAST(round(sum(estimated_warranty_exposure_usd)) AS BIGINT) FROM snap) AS exposure_usd,
  (SELECT CAST(count_if(failure_risk_category = 'CRITICAL') AS BIGINT) FROM snap) AS critical_components,
  (SELECT CAST(count(*) AS BIGINT) FROM rec) AS records,
  (SELECT round(avg(CASE WHEN anomaly_flag THEN 1 ELSE 0 END), 6) FROM rec) AS anomaly_rate,
  (SELECT round(avg(days_undetected), 6) FROM rec WHERE anomaly_flag) AS mean_days_undetected,
  (SELECT round(avg(CASE WHEN is_overdue THEN 1 ELSE 0 END), 6) FROM rec) AS overdue_rate""")
def kpi_base(spark, d):
    """AG16 + AG17 / SO8: one-row KPI base of the deck (two global aggregates)."""
    s = C.snapshot(spark, d).agg(
        F.count(F.lit(1)).cast("bigint").alias("components"),
        F.countDistinct("airline").cast("bigint").alias("operators"),
        F.countDistinct("tail_number").cast("bigint").alias("aircraft"),
        F.round(F.sum("estimated_warranty_exposure_usd")).cast("bigint").alias("exposure_usd"),
        F.count_if(F.col("failure_risk_category") == "CRITICAL").cast("bigint").alias("critical_components"))
    r = C.records(spark, d)
    rec = r.agg(F.count(F.lit(1)).cast("bigint").alias("records"),
                F.avg(F.when(F.col("anomaly_flag"), 1).otherwise(0)).alias("anomaly_rate"),
                F.avg(F.when(F.col("anomaly_flag"), F.col("days_undetected"))).alias("mean_days_undetected"),
                F.avg(F.when(F.col("is_overdue"), 1).otherwise(0)).alias("overdue_rate"))
    # two one-row aggregates side by side: scalar subqueries, no join
    return s.select("*", *[rec.select(c).scalar().alias(c) for c in rec.columns])


@query("tier_distribution", group=G, oracle=C.IB_PRE + """
SELECT failure_risk_category, CAST(count(*) AS BIGINT) AS components,
  CASE failure_risk_category WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END
    AS tier_order FROM snap GROUP BY failure_risk_category""")
def tier_distribution(spark, d):
    """AG25 / SO7 / NQ8: risk-tier counts with the custom severity order."""
    order = (F.when(F.col("failure_risk_category") == "CRITICAL", 1)
             .when(F.col("failure_risk_category") == "HIGH", 2)
             .when(F.col("failure_risk_category") == "MEDIUM", 3).otherwise(4))
    return (C.snapshot(spark, d).groupBy("failure_risk_category")
            .agg(F.count(F.lit(1)).cast("bigint").alias("components"))
            .withColumn("tier_order", order).orderBy("tier_order"))


@query("top_exposure", group=G, oracle=C.IB_PRE + """
SELECT component_id, component_type, airline, failure_risk_category, estimated_warranty_exposure_usd
FROM snap WHERE estimated_warranty_exposure_usd > 0
ORDER BY estimated_warranty_exposure_usd DESC, component_id LIMIT 10""")
def top_exposure(spark, d):
    """SO3: ten components with the largest exposure (top-k is the feature)."""
    return (C.snapshot(spark, d).filter(F.col("estimated_warranty_exposure_usd") > 0)
            .orderBy(F.col("estimated_warranty_exposure_usd").desc(), "component_id").limit(10)
            .select("component_id", "component_type", "airline", "failure_risk_category",
                    "estimated_warranty_exposure_usd"))


@query("latest_records", group=G, oracle=C.TEL_PRE + """
SELECT flight_id, record_sequence, event_ts, flight_phase, round(altitude, 6) AS altitude FROM clean
ORDER BY event_ts DESC, flight_id DESC, record_sequence DESC, flight_phase, altitude LIMIT 5""")
def latest_records(spark, d):
    """SO4: the latest five telemetry records (total order for ties)."""
    return (C.telemetry(spark, d)
            .orderBy(F.col("event_ts").desc(), F.col("flight_id").desc(),
                     F.col("record_sequence").desc(), "flight_phase", "altitude").limit(5)
            .select("flight_id", "record_sequence", "event_ts", "flight_phase", "altitude"))


@query("distinct_aircraft_types", group=G, oracle=C.TEL_PRE + """
SELECT DISTINCT aircraft_type FROM aircraft_registry ORDER BY 1""")
def distinct_aircraft_types(spark, d):
    """SRC16 / UN4: distinct parameter values, sorted."""
    return C.registry(spark, d).select("aircraft_type").distinct().orderBy("aircraft_type")


@query("visit_list", group=G, oracle=PIT_PRE + """
SELECT CAST(count(DISTINCT component_id) AS BIGINT) AS components,
  CAST(count(DISTINCT airline) AS BIGINT) AS airlines,
  round(sum(expected_warranty_exposure_usd), 6) AS expected_exposure_usd,
  max(forecast_cutoff_date) AS forecast_cutoff_date FROM fct WHERE risk_decile = 10""")
def visit_list(spark, d):
    """NQ1: the proactive visit list in numbers."""
    f = forecast(spark, d).filter(F.col("risk_decile") == 10)
    return f.agg(F.countDistinct("component_id").cast("bigint").alias("components"),
                 F.countDistinct("airline").cast("bigint").alias("airlines"),
                 F.sum("expected_warranty_exposure_usd").alias("expected_exposure_usd"),
                 F.max("forecast_cutoff_date").alias("forecast_cutoff_date"))


@query("visits_per_airline", group=G, oracle=PIT_PRE + """
SELECT airline, CAST(count(*) AS BIGINT) AS components,
  round(sum(expected_warranty_exposure_usd), 6) AS expected_exposure_usd
FROM fct WHERE risk_decile = 10 GROUP BY airline""")
def visits_per_airline(spark, d):
    """NQ7 / NQ3: visit list per airline with expected exposure."""
    return (forecast(spark, d).filter(F.col("risk_decile") == 10).groupBy("airline")
            .agg(F.count(F.lit(1)).cast("bigint").alias("components"),
                 F.sum("expected_warranty_exposure_usd").alias("expected_exposure_usd")))


@query("top_decile_by_type", group=G, oracle=PIT_PRE + """
SELECT airline, component_type, CAST(count(*) AS BIGINT) AS components FROM fct
WHERE risk_decile = 10 GROUP BY airline, component_type""")
def top_decile_by_type(spark, d):
    """NQ2 / NQ3: top-decile components by airline and type."""
    return (forecast(spark, d).filter(F.col("risk_decile") == 10)
            .groupBy("airline", "component_type").agg(F.count(F.lit(1)).cast("bigint").alias("components")))


@query("action_rollup", group=G, oracle=PIT_PRE + """
SELECT recommended_action, CAST(count(*) AS BIGINT) AS components,
  CAST(sum(actual_next_quarter_event) AS BIGINT) AS events_caught,
  round(round(sum(expected_warranty_exposure_usd)), 6) AS exp_exposure_usd
FROM fct GROUP BY recommended_action""")
def action_rollup(spark, d):
    """AG18."""
    return forecast(spark, d).groupBy("recommended_action").agg(
        F.count(F.lit(1)).cast("bigint").alias("components"),
        F.sum("actual_next_quarter_event").cast("bigint").alias("events_caught"),
        F.round(F.sum("expected_warranty_exposure_usd")).alias("exp_exposure_usd"))


@query("forecast_summary", group=G, oracle=PIT_PRE + """
SELECT CAST(count(*) AS BIGINT) AS components,
  CAST(count_if(risk_decile = 10) AS BIGINT) AS top_decile,
  CAST(sum(actual_next_quarter_event) AS BIGINT) AS events,
  CAST(sum(CASE WHEN risk_decile = 10 THEN actual_next_quarter_event ELSE 0 END) AS BIGINT) AS caught,
  round(min(forecast_probability), 6) AS min_probability,
  round(sum(expected_warranty_exposure_usd), 6) AS expected_exposure_usd FROM fct""")
def forecast_summary(spark, d):
    """AG15: count_if and conditional sums in one global aggregate."""
    f = forecast(spark, d)
    return f.agg(F.count(F.lit(1)).cast("bigint").alias("components"),
                 F.count_if(F.col("risk_decile") == 10).cast("bigint").alias("top_decile"),
                 F.sum("actual_next_quarter_event").cast("bigint").alias("events"),
                 F.sum(F.when(F.col("risk_decile") == 10, F.col("actual_next_quarter_event"))
                       .otherwise(0)).cast("bigint").alias("caught"),
                 F.min("forecast_probability").alias("min_probability"),
                 F.sum("expected_warranty_exposure_usd").alias("expected_exposure_usd"))


@query("fault_to_risk", group=G, oracle=C.TEL_PRE + f"""
SELECT p.flight_id, p.anomaly_type, p.tail_number, h.airline, round(h.health_risk_score, 6)
    AS health_risk_score,
  CASE WHEN h.health_risk_score <= 20 THEN 'LOW' WHEN h.health_risk_score <= 40 THEN 'MEDIUM'
       WHEN h.health_risk_score <= 60 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_tier
FROM ({_o('peak_events')}) p JOIN ({_o('aircraft_health')}) h ON h.tail_number = p.tail_number
WHERE p.anomaly_type = 'EGT_EXCEEDANCE'""")
def fault_to_risk(spark, d):
    """JN20: aircraft that had a given fault, with their risk tier (SC11 bins)."""
    p = _q(spark, d, "peak_events").filter(F.col("anomaly_type") == "EGT_EXCEEDANCE")
    h = _q(spark, d, "aircraft_health").select("tail_number", "airline", "health_risk_score")
    return p.select("flight_id", "anomaly_type", "tail_number").join(h, "tail_number", "inner") \
        .withColumn("risk_tier", scoring.priority_tier(F.col("health_risk_score")))


@query("class_balance", group=G, oracle=C.TEL_PRE + """
SELECT anomaly_type IS NOT NULL AS is_anomalous, coalesce(anomaly_severity, 'NONE') AS severity,
  CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY ALL""")
def class_balance(spark, d):
    """AG26 / ML3a: label value counts (null label -> normal)."""
    t = C.telemetry(spark, d)
    return t.groupBy(F.col("anomaly_type").isNotNull().alias("is_anomalous"),
                     F.coalesce("anomaly_severity", F.lit("NONE")).alias("severity")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))


_MBC = ["egt_eng1", "vibration_n1_eng1", "oil_pressure_eng1", "hyd_press_sys2"]


@query("mean_by_class", group=G, oracle=C.TEL_PRE + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS sensor, round(avg({c}) FILTER (WHERE anomaly_type IS NULL), 6) AS normal_mean,
  round(avg({c}) FILTER (WHERE anomaly_type IS NOT NULL), 6) AS anomalous_mean,
  round((avg({c}) FILTER (WHERE anomaly_type IS NOT NULL) - avg({c}) FILTER (WHERE anomaly_type IS NULL))
    / nullif(avg({c}) FILTER (WHERE anomaly_type IS NULL), 0) * 100, 6) AS pct_diff FROM clean"""
    for c in _MBC))
def mean_by_class(spark, d):
    """AG27: class means and percent difference (null when the base is 0)."""
    t = C.telemetry(spark, d)
    anom = F.col("anomaly_type").isNotNull()
    wide = t.agg(*[F.avg(F.when(~anom, F.col(c))).alias(f"n_{c}") for c in _MBC],
                 *[F.avg(F.when(anom, F.col(c))).alias(f"a_{c}") for c in _MBC])
    stack = ", ".join(f"'{c}', n_{c}, a_{c}" for c in _MBC)
    out = wide.selectExpr(f"stack({len(_MBC)}, {stack}) AS (sensor, normal_mean, anomalous_mean)")
    return out.withColumn("pct_diff", F.try_divide(F.col("anomalous_mean") - F.col("normal_mean"),
                                                   F.col("normal_mean")) * 100)


_CM = ["egt_eng1", "vibration_n1_eng1", "fuel_flow_eng1", "oil_pressure_eng1"]


@query("corr_matrix", group=G, oracle=C.TEL_PRE + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM clean"
    for a in _CM for b in _CM))
def corr_matrix(spark, d):
    """AG28: pairwise correlation matrix in long form, one aggregate."""
    t = C.telemetry(spark, d)
    pairs = [(a, b) for a in _CM for b in _CM]
    wide = t.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, corr)")


@query("generator_audit", group=G, oracle=C.IB_PRE + """
SELECT anomaly_type, anomaly_severity, flight_delay_risk, CAST(count(*) AS BIGINT) AS n
FROM rec WHERE anomaly_flag GROUP BY ALL""")
def generator_audit(spark, d):
    """AG31: anomaly breakdown by type, severity and delay risk."""
    return (C.records(spark, d).filter("anomaly_flag")
            .groupBy("anomaly_type", "anomaly_severity", "flight_delay_risk")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@query("starter_top_anomaly_types", group=G, oracle=C.IB_PRE + """
SELECT anomaly_type, CAST(count(*) AS BIGINT) AS anomalies FROM em WHERE anomaly_flag
GROUP BY anomaly_type ORDER BY anomalies DESC, anomaly_type LIMIT 5""")
def starter_top_anomaly_types(spark, d):
    """NQ5: top anomaly types (top-k is the feature)."""
    return (C.enriched_maintenance(spark, d).filter("anomaly_flag").groupBy("anomaly_type")
            .agg(F.count(F.lit(1)).cast("bigint").alias("anomalies"))
            .orderBy(F.col("anomalies").desc(), "anomaly_type").limit(5))


@query("starter_health_by_type", group=G, oracle=C.IB_PRE + """
SELECT component_type, round(avg(health_index), 6) AS avg_health_index,
  CAST(count_if(has_active_anomaly AND failure_risk_category = 'CRITICAL') AS BIGINT)
    AS critical_with_active_anomaly FROM snap GROUP BY component_type""")
def starter_health_by_type(spark, d):
    """NQ5: health by component type and critical components with active anomalies."""
    return C.snapshot(spark, d).groupBy("component_type").agg(
        F.avg("health_index").alias("avg_health_index"),
        F.count_if(F.col("has_active_anomaly") & (F.col("failure_risk_category") == "CRITICAL"))
        .cast("bigint").alias("critical_with_active_anomaly"))


@query("compliance_by_airline_type", group=G, oracle=C.IB_PRE + """
SELECT airline, component_type, round(avg(compliance_score), 6) AS avg_compliance_score,
  round(avg(overdue_days), 6) AS avg_overdue_days,
  CASE WHEN avg(compliance_score) < 0.80 THEN 'HIGH' WHEN avg(compliance_score) < 0.90 THEN 'MEDIUM'
       ELSE 'LOW' END AS sla_breach_risk FROM em GROUP BY airline, component_type""")
def compliance_by_airline_type(spark, d):
    """NQ4: compliance by airline x type (rate, avg overdue, SLA risk)."""
    return C.enriched_maintenance(spark, d).groupBy("airline", "component_type").agg(
        F.avg("compliance_score").alias("avg_compliance_score"),
        F.avg("overdue_days").alias("avg_overdue_days")).withColumn(
        "sla_breach_risk", scoring.sla_breach_risk("avg_compliance_score"))
