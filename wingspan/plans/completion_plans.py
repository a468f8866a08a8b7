"""Smaller operators, each as a query of its own with an oracle written by hand."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from wingspan.functions import scoring
from wingspan.operators import installed_base as ib
from wingspan.operators import manuals as MN
from wingspan.operators import security as sec
from wingspan.operators import telemetry as tm
from wingspan.operators.expectations import assert_unique
from wingspan.plans import common as C
from wingspan.plans.feature_plans import PIT_PRE, forecast, pit
from wingspan.plans.registry import all_oracles, all_queries, query
from wingspan.sources.driver import read_table
from wingspan.streaming import ingest

G = "completion"


@query("rule_priority", group=G, oracle=f"""
WITH h AS ({all_oracles()['aircraft_health']}),
p AS (SELECT tail_number, airline, least(1.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(anomaly_rate, 0.0)::DOUBLE * 3.0::DOUBLE)) AS prob,
    coalesce(nullif(health_risk_score, 0), 8.0)::DOUBLE AS hrs, coalesce(nullif(days_until_next_maintenance, 0), 180) AS days
  FROM h),
s AS (SELECT *, least(100.0::DOUBLE, prob * 40::DOUBLE + hrs * 0.5::DOUBLE
    + greatest(0.0::DOUBLE, (180 - days)::DOUBLE / 180.0::DOUBLE) * 20::DOUBLE) AS score FROM p)
SELECT tail_number, airline, round(prob, 6) AS anomaly_probability, CAST(floor(score) AS BIGINT) AS priority_points,
  CASE WHEN score > 75 THEN 'CRITICAL' WHEN score > 50 THEN 'HIGH' WHEN score > 25 THEN 'MEDIUM' ELSE 'LOW' END
    AS risk_category FROM s""")
def rule_priority(spark, d):
    """SC12: priority by rules only (the fitted variant is ``asset_priority_model``), noise left out."""
    h = all_queries()["aircraft_health"](spark, d)
    prob = scoring.rule_anomaly_probability(F.col("anomaly_rate"), F.col("airline"))
    score = scoring.rule_priority(prob, F.col("health_risk_score"), F.col("days_until_next_maintenance"))
    return h.select("tail_number", "airline", prob.alias("anomaly_probability"), F.floor(score).alias("priority_points"),
                    scoring.rule_priority_tier(score).alias("risk_category"))


@query("aircraft_by_tier", group=G, oracle=f"""
SELECT risk_category, CAST(count(DISTINCT tail_number) AS BIGINT) AS aircraft
FROM ({all_oracles()['asset_priority']}) GROUP BY risk_category""")
def aircraft_by_tier(spark, d):
    """NQ8: aircraft (not components) by risk tier."""
    return all_queries()["asset_priority"](spark, d).groupBy("risk_category").agg(
        F.count_distinct("tail_number").cast("bigint").alias("aircraft"))


@query("top_forecast", group=G, oracle=PIT_PRE + """
SELECT component_id, airline, round(forecast_probability, 6) AS forecast_probability FROM fct
ORDER BY fct.forecast_probability DESC, component_id LIMIT 5""")
def top_forecast(spark, d):
    """SO2: the five components with the highest forecast probability, ties by id (top-k is the feature)."""
    return (forecast(spark, d).select("component_id", "airline", "forecast_probability")
            .orderBy(F.col("forecast_probability").desc(), "component_id").limit(5))


@query("risk_by_anomaly_type", group=G, oracle=C.IB_PRE + """
SELECT flight_delay_risk, anomaly_type, CAST(count(*) AS BIGINT) AS n FROM rec GROUP BY ALL""")
def risk_by_anomaly_type(spark, d):
    """AG31: record counts by (risk, type)."""
    return C.records(spark, d).groupBy("flight_delay_risk", "anomaly_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("event_variants", group=G, oracle="""
WITH e AS (SELECT event_type, json_array_length('[' || props || ', null]') AS items,
    json_type(('[' || props || ', null]')::JSON, '$[1]') = 'NULL' AS last_null,
    coalesce(json_type(props::JSON, '$.k') = 'NULL', false) AS k_null FROM events)
SELECT event_type, CAST(sum(items) AS BIGINT) AS items, CAST(count_if(last_null) AS BIGINT) AS null_items,
  CAST(count_if(k_null) AS BIGINT) AS null_k,
  CAST(sum(CASE event_type WHEN 'error' THEN 5 WHEN 'purchase' THEN 3 ELSE 1 END) AS BIGINT) AS weight
FROM e GROUP BY event_type""")
def event_variants(spark, d):
    """SF21 + SF22: arrays of variants, variant null tests, weights from a map literal."""
    ev = read_table(spark, d, "events")
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "props", F.lit(", null]"))), "$", "array<variant>")
    weight = F.coalesce(F.get(F.array(F.element_at(F.create_map(
        F.lit("error"), F.lit(5), F.lit("purchase"), F.lit(3)), F.col("event_type"))), F.lit(0)), F.lit(1))
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "variant")
    return ev.withColumn("v", items).groupBy("event_type").agg(
        F.sum(F.size("v")).cast("bigint").alias("items"),
        F.sum(F.size(F.filter("v", lambda x: F.is_variant_null(x)))).cast("bigint").alias("null_items"),
        F.count_if(F.coalesce(F.is_variant_null(k), F.lit(False))).cast("bigint").alias("null_k"),
        F.sum(weight).cast("bigint").alias("weight"))


@query("severity_weight", group=G, oracle=C.IB_PRE + """
SELECT v.severity, v.weight, CAST(count(r.record_id) AS BIGINT) AS records
FROM (VALUES ('CRITICAL', 4), ('HIGH', 3), ('MEDIUM', 2), ('LOW', 1)) AS v(severity, weight)
LEFT JOIN rec r ON r.anomaly_severity = v.severity GROUP BY v.severity, v.weight""")
def severity_weight(spark, d):
    """SRC12: an inline VALUES relation with column aliases joined to the records."""
    return spark.sql("""SELECT v.severity, v.weight, count(r.record_id) AS records
      FROM VALUES ('CRITICAL', 4), ('HIGH', 3), ('MEDIUM', 2), ('LOW', 1) AS v(severity, weight)
      LEFT JOIN {rec} r ON r.anomaly_severity = v.severity GROUP BY v.severity, v.weight""",
                     rec=C.records(spark, d))


_TEL_WARN = "\nUNION ALL\n".join(
    f"SELECT 'telemetry' AS feed, '{n}' AS rule, CAST(count_if(NOT coalesce({s}, false)) AS BIGINT) AS violations, "
    f"CAST(count(*) AS BIGINT) AS total_rows FROM enriched" for n, s in tm.ENRICHMENT_WARN_RULES.items())
_REC_WARN = "\nUNION ALL\n".join(
    f"SELECT 'maintenance' AS feed, '{n}' AS rule, CAST(count_if(NOT coalesce({s}, false)) AS BIGINT) AS violations, "
    f"CAST(count(*) AS BIGINT) AS total_rows FROM em" for n, s in ib.ENRICHED_WARN_RULES.items())
_STREAM_WARN = _TEL_WARN.replace("'telemetry' AS feed", "'telemetry_stream' AS feed")


def _counted(spark, feed: str, metrics: dict):
    rows = [(feed, k, int(v), int(metrics["_rows_in"])) for k, v in metrics.items() if k != "_rows_in"]
    return spark.createDataFrame(rows, "feed string, rule string, violations long, total_rows long")


@query("warn_rule_counts", group=G, oracle=f"""
SELECT * FROM ({C.TEL_PRE} {_TEL_WARN}
UNION ALL {_STREAM_WARN})
UNION ALL SELECT * FROM ({C.IB_PRE} {_REC_WARN})""")
def warn_rule_counts(spark, d):
    """DQ5-DQ7: violations counted while the rows flow on, for two batch feeds and a stream."""
    a, b = Observation("telemetry_warnings"), Observation("maintenance_warnings")
    tel = tm.enrich_telemetry(C.telemetry(spark, d), C.flights(spark, d), C.registry(spark, d), a)
    tel.write.format("noop").mode("overwrite").save()
    rec = ib.enrich_maintenance(C.records(spark, d), C.components(spark, d), C.ib_aircraft(spark, d), b)
    rec.write.format("noop").mode("overwrite").save()
    live = ingest.observed_enrichment(spark, d, C.flights(spark, d), C.registry(spark, d))
    return (_counted(spark, "telemetry", a.get).unionByName(_counted(spark, "maintenance", b.get))
            .unionByName(_counted(spark, "telemetry_stream", live)))


@query("component_grain", group=G, oracle=f"""
SELECT component_id, total_service_events FROM ({all_oracles()['component_health']})""")
def component_grain(spark, d):
    """DQ8: the gold component table with the fail rule ``unique_component_grain``."""
    out = all_queries()["component_health"](spark, d).select("component_id", "total_service_events")
    return assert_unique(out, ["component_id"], "unique_component_grain")


@query("streamed_daily", group=G, oracle=C.TEL_PRE + """
SELECT CAST(event_ts AS DATE) AS event_date, flight_phase, CAST(count(*) AS BIGINT) AS records,
  round(avg(egt_eng1), 6) AS avg_egt FROM clean GROUP BY ALL""")
def streamed_daily(spark, d):
    """ST4: a batch aggregate over a table that a stream wrote."""
    sink = ingest.scratch_path(spark, "streamed")
    flow = tm.bronze_telemetry(ingest.bound_stream(spark, d, "telemetry"))
    ingest.run_to_sink(flow, sink, ingest.scratch_path(spark, "ckpt-streamed"), "streamed_daily")
    return spark.read.parquet(sink).groupBy(F.to_date("event_ts").alias("event_date"), "flight_phase").agg(
        F.count(F.lit(1)).cast("bigint").alias("records"), F.avg("egt_eng1").alias("avg_egt"))


@query("security_inventory", group=G, oracle=C.IB_PRE + """
, t AS (SELECT * FROM (VALUES ('forecast_table', 'row_filter', 'airline', 'airline_row_filter'),
    ('forecast_table', 'column_mask', 'expected_warranty_exposure_usd', 'financial_mask'),
    ('customer_operations', 'row_filter', 'airline', 'airline_row_filter')) v(table_name, kind, column_name, function))
SELECT t.*, CAST((SELECT count(*) FROM al) + 3 AS BIGINT) AS principals,
  CAST(CASE kind WHEN 'column_mask' THEN 2 ELSE 3 END AS BIGINT) AS every_airline FROM t""")
def security_inventory(spark, d):
    """SE4: filters and masks in force, the principals behind them, and those that reach every airline."""
    return sec.security_inventory(sec.entitlements(spark, C.airlines(spark, d)))


def _task_sql(n: int) -> str:
    pair = "lpad(CAST((p_partkey * {k}) % 100 AS VARCHAR), 2, '0')"
    ata = f"{pair.format(k=1)} || '-' || {pair.format(k=7)} || '-0{n}'"
    return f"""SELECT p_type || '|' || {ata} AS chunk_id, 'manual_' || p_partkey || '.txt' AS manual_name,
  p_type AS aircraft_type, p_brand AS engine, {ata} AS ata_chapter,
  'TASK ' || {ata} || ' Inspect ' || p_name || ' for wear' AS task_title, 'F' || (p_partkey % 10) AS fault_code,
  'fuel and oil' AS system, p_name AS part_name, 'PN-' || p_partkey AS part_number, '' AS related_parts,
  'noise' AS symptoms, 'Remove ' || p_name || chr(10) || 'Fit size {n} ' || p_size AS corrective_steps,
  p_size || ' Nm' AS torque_values FROM part"""


@query("manual_chunks", group=G, oracle=_task_sql(1) + "\nUNION ALL\n" + _task_sql(2))
def manual_chunks(spark, d):
    """TX2-TX5 + SF16-SF18 + UD3: manuals of the part table split and parsed back into their fields."""
    return MN.manual_chunks(MN.part_manuals(read_table(spark, d, "part"))).drop(
        "source_path", "probable_causes", "limits", "content", "search_text")


@query("forecast_oof_rows", group=G, oracle=all_oracles()["stratified_folds"].replace(
    "SELECT component_id, y,", "SELECT component_id, y, true AS probability_in_range,"))
def forecast_oof_rows(spark, d):
    """ML6 + ML9: fold, label and range of every out-of-fold probability."""
    from wingspan.operators import models as M
    out = M.oof_scores(pit(spark, d), "logreg")
    return out.select("component_id", "y", F.col("forecast_probability").between(0, 1).alias("probability_in_range"),
                      "fold")


@query("isolation_rows", group=G, oracle=C.TEL_PRE + """
SELECT CAST(count(*) AS BIGINT) AS rows_in, true AS scores_in_range, true AS outlier_share_ok FROM clean
WHERE egt_eng1 IS NOT NULL AND egt_eng2 IS NOT NULL AND vibration_n1_eng1 IS NOT NULL AND vibration_n1_eng2 IS NOT NULL
  AND oil_pressure_eng1 IS NOT NULL AND oil_pressure_eng2 IS NOT NULL AND fuel_flow_eng1 IS NOT NULL
  AND hyd_press_sys1 IS NOT NULL""")
def isolation_rows(spark, d):
    """ML11 + FLT9: every record without a null sensor scored in (0, 1), about a tenth of them outliers."""
    from wingspan.operators import models as M
    from wingspan.plans.model_plans import ISO_FEATURES
    t = C.telemetry(spark, d).na.drop(subset=ISO_FEATURES)
    s = M.isolation_forest(t, ISO_FEATURES, ["flight_id", "record_sequence", "event_ts"], trees=50)
    share = F.avg(F.col("is_outlier").cast("double"))
    return s.agg(F.count("*").cast("bigint").alias("rows_in"),
                 F.bool_and(F.col("anomaly_score").between(0, 1)).alias("scores_in_range"),
                 share.between(0.02, 0.12).alias("outlier_share_ok"))


