"""Model queries (ML8-ML11, ML22): MLlib fits, rows-only checks; asset priority in SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from wingspan.functions import scoring
from wingspan.operators import models as M
from wingspan.operators.evaluation import class_report
from wingspan.plans import common as C
from wingspan.plans.feature_plans import pit
from wingspan.plans.registry import all_oracles, all_queries, query
from wingspan.session import materialize, scratch_path

G = "models"
FOREST_FEATURES = ["altitude", "indicated_airspeed", "egt_eng1", "egt_eng2", "vibration_n1_eng1",
                   "vibration_n2_eng1", "fuel_flow_eng1", "oil_pressure_eng1", "hyd_press_sys1",
                   "hyd_press_sys2"]
ISO_FEATURES = ["egt_eng1", "egt_eng2", "vibration_n1_eng1", "vibration_n1_eng2", "oil_pressure_eng1",
                "oil_pressure_eng2", "fuel_flow_eng1", "hyd_press_sys1"]


@query("forecast_oof", group=G)
def forecast_oof(spark, d):
    """ML6 + ML7 + ML9: out-of-fold logistic probabilities (stratified 5-fold, balanced)."""
    return M.oof_scores(pit(spark, d), "logreg")


@query("forecast_gbt_oof", group=G)
def forecast_gbt_oof(spark, d):
    """ML6 + ML7 + ML8: out-of-fold gradient-boosted-tree probabilities."""
    return M.oof_scores(pit(spark, d), "gbt")


@query("anomaly_type_forest", group=G)
def anomaly_type_forest(spark, d):
    """ML10 + ML5 + ML15: forest over anomaly types, per-class report on the hold-out."""
    rows = C.telemetry(spark, d).filter(F.col("anomaly_type").isNotNull())
    pred, _ = M.anomaly_type_forest(rows, FOREST_FEATURES)
    return class_report(pred, "actual", "predicted")


@query("isolation_scores", group=G)
def isolation_scores(spark, d):
    """ML11 + FLT10: isolation forest on a deterministic 10% sample of the telemetry."""
    t = C.telemetry(spark, d).na.drop(subset=ISO_FEATURES)  # FLT9
    sample = t.filter(F.pmod(F.xxhash64("flight_id", "record_sequence", "event_ts"), F.lit(10)) == 0)
    return M.isolation_forest(sample, ISO_FEATURES, ["flight_id", "record_sequence", "event_ts"])


_LATEST = ["max_egt_eng1", "avg_cruise_speed"]


def _latest_oracle():
    fs = all_oracles()["flight_summary"]
    parts = []
    for c in _LATEST:
        parts.append(f"""l_{c} AS (SELECT tail_number, {c} AS latest_{c} FROM (SELECT *, row_number() OVER (
  PARTITION BY tail_number ORDER BY departure_time DESC, flight_id DESC, anomaly_type DESC NULLS LAST,
  anomaly_severity DESC NULLS LAST) AS rn FROM s WHERE {c} IS NOT NULL) WHERE rn = 1)""")
    joins = " ".join(f"LEFT JOIN l_{c} ON l_{c}.tail_number = h.tail_number" for c in _LATEST)
    pr = ("least(greatest(h.anomaly_rate * 35 + h.health_risk_score * 0.35 + CASE WHEN "
          "coalesce(h.days_until_next_maintenance, 365) < 30 THEN 30.0 WHEN "
          "coalesce(h.days_until_next_maintenance, 365) < 90 THEN 15.0 ELSE 0.0 END, 0.0), 100.0)")
    return f"""WITH s AS ({fs}), h AS ({all_oracles()['aircraft_health']}), {", ".join(parts)}
SELECT h.tail_number, h.airline, {", ".join(f"latest_{c}" for c in _LATEST)},
  h.anomaly_rate AS ml_anomaly_probability, h.health_risk_score, h.days_until_next_maintenance,
  round({pr}, 6) AS maintenance_priority_score,
  CASE WHEN {pr} <= 20 THEN 'LOW' WHEN {pr} <= 40 THEN 'MEDIUM' WHEN {pr} <= 60 THEN 'HIGH'
       ELSE 'CRITICAL' END AS risk_category
FROM h {joins}"""


@query("asset_priority", group=G, oracle=_latest_oracle())
def asset_priority(spark, d):
    """WN7 (D12) + SC10 + SC11: latest non-null state per aircraft, rule priority and tier.

    The rule variant, which SQL can check: its anomaly probability is the
    aircraft's observed anomaly rate.  The fitted one is
    ``asset_priority_model``.
    """
    s = all_queries()["flight_summary"](spark, d)
    key = F.struct(F.col("departure_time"), F.col("flight_id"), F.col("anomaly_type"),
                   F.col("anomaly_severity"))
    latest = s.groupBy("tail_number").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"latest_{c}") for c in _LATEST])
    h = all_queries()["aircraft_health"](spark, d)
    j = h.join(latest, "tail_number", "left")
    prio = scoring.maintenance_priority(F.col("anomaly_rate"), F.col("health_risk_score"),
                                        F.col("days_until_next_maintenance"))
    return j.select("tail_number", "airline", *[f"latest_{c}" for c in _LATEST],
                    F.col("anomaly_rate").alias("ml_anomaly_probability"), "health_risk_score",
                    "days_until_next_maintenance", prio.alias("maintenance_priority_score"),
                    scoring.priority_tier(prio).alias("risk_category"))


_FLIGHT_ORDER = ["departure_time", "flight_id", "anomaly_type", "anomaly_severity"]


@query("flight_anomaly_holdout", group=G)
def flight_anomaly_holdout(spark, d):
    """ML5 + ML7 + ML8 + ML15: flight-level boosted trees, per-class report on the hold-out."""
    _, pred = M.flight_anomaly_model(all_queries()["flight_summary"](spark, d))
    return class_report(pred, "actual", "predicted")


@query("asset_priority_model", group=G)
def asset_priority_model(spark, d):
    """ML22 + WN7 (D12) + SC10 + SC11: every aircraft's latest features scored by the flight-level trees."""
    s = materialize(all_queries()["flight_summary"](spark, d), "flights")
    model, _ = M.flight_anomaly_model(s)
    scored = M.latest_scores(s, model, _FLIGHT_ORDER).select("tail_number", "ml_anomaly_probability")
    j = all_queries()["aircraft_health"](spark, d).join(scored, "tail_number", "left")
    prio = scoring.maintenance_priority(F.col("ml_anomaly_probability"), F.col("health_risk_score"),
                                        F.col("days_until_next_maintenance"))
    return j.select("tail_number", "airline", "aircraft_type", "ml_anomaly_probability", "health_risk_score",
                    "days_until_next_maintenance", prio.alias("maintenance_priority_score"),
                    scoring.priority_tier(prio).alias("risk_category"))


@query("model_selection", group=G)
def model_selection(spark, d):
    """ML12-ML14 + ML20 + ML21 + ML25: out-of-fold logistic and trees vs rule baseline, best by capture.

    The run's parameters and metrics are appended to a ``model_runs`` table
    in the shared checkpoint folder.
    """
    from wingspan.operators.features import rule_baseline_score
    p = materialize(pit(spark, d), "pit")  # read by every fold and metric
    lr, gbt = (materialize(x, "oof") for x in M.side_by_side(
        spark, [partial(M.oof_scores, p, "logreg"), partial(M.oof_scores, p, "gbt")]))
    rule = rule_baseline_score(p).withColumnRenamed("score", "forecast_probability")
    cands = {"logreg": lr, "gbt": gbt, "rule_baseline": rule.select("component_id", "y", "forecast_probability")}
    out = M.compare_models(cands)
    best = out.filter("best").orderBy("model").first()
    M.log_run(spark, scratch_path(spark, "model_runs"), {"model": best.model, "cv": "stratified 5-fold"},
              {"roc_auc": best.roc_auc or 0.0, "pr_auc": best.pr_auc or 0.0,
               "top_decile_capture": best.top_decile_capture or 0.0})
    return out


@query("forecast_model_table", group=G)
def forecast_model_table(spark, d):
    """ML21-ML23: the better of logistic and trees by capture, refitted on all rows; its forecast table.

    The rule-score variant, which SQL can check, is ``forecast_table``.
    """
    from wingspan.operators import evaluation as ev
    from wingspan.operators import forecast as fc
    from wingspan.plans.feature_plans import CUT
    p = materialize(pit(spark, d), "pit")  # read by every fold and the refit
    capture, kinds = {}, ("logreg", "gbt")
    for kind, oof in zip(kinds, M.side_by_side(spark, [partial(M.oof_scores, p, kind) for kind in kinds])):
        scored = materialize(oof.select("component_id", "y", F.col("forecast_probability").alias("score")), "oof")
        capture[kind] = ev.top_decile_capture(scored, "component_id").first().top_decile_capture or 0.0
    best = max(sorted(capture, reverse=True), key=capture.get)
    scored = p.join(M.refit_scores(p, best), "component_id")
    return fc.forecast_table(scored, CUT).withColumn("model", F.lit(best))


@query("forest_feature_importance", group=G)
def forest_feature_importance(spark, d):
    """ML19: ranked feature importances of the anomaly-type forest."""
    rows = C.telemetry(spark, d).filter(F.col("anomaly_type").isNotNull())
    _, ranked = M.anomaly_type_forest(rows, FOREST_FEATURES)
    return spark.createDataFrame([(i + 1, f, float(v)) for i, (f, v) in enumerate(ranked)],
                                 "rank int, feature string, importance double")
