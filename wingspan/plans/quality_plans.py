"""Data-quality queries (DQ1-DQ15, UN5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.operators import expectations as X
from wingspan.operators import telemetry as tm
from wingspan.plans import common as C
from wingspan.plans.feature_plans import PIT_PRE, pit
from wingspan.plans.registry import query
from wingspan.sources.bindings import bound, oracle_prelude
from wingspan.sources.driver import read_table

G = "quality"
_RULES = X.rules(tm.BRONZE_TELEMETRY_RULES, "drop")


def _violation_oracle():
    pre = oracle_prelude("telemetry")
    parts = [f"SELECT '{e.name}' AS rule, '{e.action}' AS action, "
             f"CAST(count_if(NOT coalesce({e.sql}, false)) AS BIGINT) AS violations, "
             f"CAST(count(*) AS BIGINT) AS total_rows FROM telemetry" for e in _RULES]
    return pre + "\nUNION ALL\n".join(parts)


@query("dq_violation_counts", group=G, oracle=_violation_oracle())
def dq_violation_counts(spark, d):
    """DQ1/DQ5: violations per rule in one aggregate (stack to rows)."""
    return X.violation_counts(bound(spark, d, "telemetry"), _RULES)


def _quarantine_oracle():
    failed = ", ".join(f"CASE WHEN NOT coalesce({e.sql}, false) THEN '{e.name}' END" for e in _RULES)
    ok = " AND ".join(f"coalesce({e.sql}, false)" for e in _RULES)
    return oracle_prelude("telemetry") + f"""
SELECT flight_id, record_sequence, event_ts, concat_ws(',', {failed}) AS failed_rules
FROM telemetry WHERE NOT ({ok})"""


@query("dq_drop_invalid", group=G, oracle=_quarantine_oracle())
def dq_drop_invalid(spark, d):
    """DQ1: the rows the bronze drop rules remove, with the rules they broke."""
    return X.quarantine(bound(spark, d, "telemetry"), _RULES,
                        ["flight_id", "record_sequence", "event_ts"])


@query("dq_unmatched_join", group=G, oracle=oracle_prelude("flights", "telemetry", "maintenance",
                                                              "components") + """
SELECT 'flights_without_telemetry' AS check_name,
  CAST((SELECT count(*) FROM flights f WHERE NOT EXISTS (SELECT 1 FROM telemetry t
        WHERE t.flight_id = f.flight_id)) AS BIGINT) AS unmatched_rows,
  CAST((SELECT count(*) FROM flights) AS BIGINT) AS total_rows
UNION ALL SELECT 'records_without_component',
  CAST((SELECT count(*) FROM maintenance m WHERE NOT EXISTS (SELECT 1 FROM components c
        WHERE c.component_id = m.component_id)) AS BIGINT),
  CAST((SELECT count(*) FROM maintenance) AS BIGINT)
UNION ALL SELECT 'documents_without_labels',
  CAST((SELECT count(*) FROM documents dd WHERE NOT EXISTS (SELECT 1 FROM labels l
        WHERE l.doc_id = dd.doc_id)) AS BIGINT),
  CAST((SELECT count(*) FROM documents) AS BIGINT)""")
def dq_unmatched_join(spark, d):
    """DQ13 / JN19: left-anti match checks after the enrichment joins."""
    fl, tel = bound(spark, d, "flights"), bound(spark, d, "telemetry")
    rec, comp = bound(spark, d, "maintenance"), bound(spark, d, "components")
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")

    def chk(name, left, right, key):
        miss = left.join(right.select(key), key, "left_anti")
        return miss.agg(F.count(F.lit(1)).cast("bigint").alias("unmatched_rows")).select(
            F.lit(name).alias("check_name"), "unmatched_rows",
            left.select(F.count(F.lit(1)).cast("bigint")).scalar().alias("total_rows"))
    return (chk("flights_without_telemetry", fl, tel, "flight_id")
            .unionByName(chk("records_without_component", rec, comp, "component_id"))
            .unionByName(chk("documents_without_labels", docs, labels, "doc_id")))


@query("dq_uniqueness", group=G, oracle=oracle_prelude("telemetry") + """
SELECT flight_id, record_sequence, CAST(count(*) AS BIGINT) AS n_rows FROM telemetry
GROUP BY flight_id, record_sequence HAVING count(*) > 1""")
def dq_uniqueness(spark, d):
    """DQ8: a real uniqueness check of the (flight, sequence) grain."""
    return X.duplicate_keys(bound(spark, d, "telemetry"), ["flight_id", "record_sequence"])


@query("dq_profile_union", group=G, oracle=C.IB_PRE + """
SELECT 'severity' AS profile, anomaly_severity AS profile_key, CAST(count(*) AS BIGINT) AS n,
  round(avg(days_undetected), 6) AS avg_days_undetected,
  round(avg(CAST(warranty_claim_risk AS INT)), 6) AS warranty_rate, CAST(NULL AS DOUBLE) AS anomaly_rate
FROM rec WHERE anomaly_flag GROUP BY anomaly_severity
UNION ALL
SELECT 'anomaly_type', anomaly_type, CAST(count(*) AS BIGINT), round(avg(days_undetected), 6),
  CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM rec WHERE anomaly_flag GROUP BY anomaly_type
UNION ALL
SELECT 'overdue', CAST(is_overdue AS VARCHAR), CAST(count(*) AS BIGINT), CAST(NULL AS DOUBLE),
  CAST(NULL AS DOUBLE), round(avg(CAST(anomaly_flag AS INT)), 6) FROM rec GROUP BY is_overdue""")
def dq_profile_union(spark, d):
    """DQ14: realism profile, three groupings in one result (typed nulls, UN3)."""
    r = C.records(spark, d)
    a = r.filter("anomaly_flag")
    sev = a.groupBy(F.col("anomaly_severity").alias("profile_key")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("days_undetected").alias("avg_days_undetected"),
        F.avg(F.col("warranty_claim_risk").cast("int")).alias("warranty_rate")) \
        .withColumn("profile", F.lit("severity"))
    typ = a.groupBy(F.col("anomaly_type").alias("profile_key")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("days_undetected").alias("avg_days_undetected")) \
        .withColumn("profile", F.lit("anomaly_type"))
    ovd = r.groupBy(F.col("is_overdue").cast("string").alias("profile_key")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(F.col("anomaly_flag").cast("int")).alias("anomaly_rate")) \
        .withColumn("profile", F.lit("overdue"))
    out = sev.unionByName(typ, allowMissingColumns=True).unionByName(ovd, allowMissingColumns=True)
    return out.select("profile", "profile_key", "n",
                      *[F.col(c).cast("double").alias(c) for c in
                        ("avg_days_undetected", "warranty_rate", "anomaly_rate")])


_CORR = ["n_services", "overdue_rate", "avg_gap", "n_anom", "n_anom_hc", "n_warr", "compliance_rate",
         "cycle_life_used", "n_future_events"]


@query("dq_corr_screen", group=G, oracle=PIT_PRE + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(y AS DOUBLE)), 6) AS corr_with_label, "
    f"abs(corr(CAST({c} AS DOUBLE), CAST(y AS DOUBLE))) >= 0.9 AS leaky FROM pit" for c in _CORR))
def dq_corr_screen(spark, d):
    """DQ15: target-leakage screen, correlation of each candidate with the label, one agg."""
    p = pit(spark, d)
    wide = p.agg(*[F.corr(F.col(c).cast("double"), F.col("y").cast("double")).alias(c) for c in _CORR])
    stack = ", ".join(f"'{c}', `{c}`" for c in _CORR)
    return (wide.selectExpr(f"stack({len(_CORR)}, {stack}) AS (feature, corr_with_label)")
            .withColumn("leaky", F.abs("corr_with_label") >= 0.9))


@query("table_diff", group=G, oracle=oracle_prelude("flights", "telemetry") + """
, a AS (SELECT flight_id FROM flights WHERE has_anomaly)
, b AS (SELECT DISTINCT flight_id FROM telemetry WHERE anomaly_type IS NOT NULL)
SELECT flight_id, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT flight_id, 'right_only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def table_diff(spark, d):
    """DQ12 / UN5: two-way multiset difference (flight label vs telemetry labels)."""
    a = bound(spark, d, "flights").filter("has_anomaly").select("flight_id")
    b = bound(spark, d, "telemetry").filter(F.col("anomaly_type").isNotNull()) \
        .select("flight_id").distinct()
    return X.table_diff(a, b)


@query("event_props", group=G, oracle="""
SELECT event_type, CAST(count(*) AS BIGINT) AS events,
  CAST(count(json_extract(props, '$.k')) AS BIGINT) AS with_k,
  round(avg(CAST(json_extract(props, '$.k') AS INTEGER)), 6) AS avg_k,
  CAST(max(CAST(json_extract(props, '$.k') AS INTEGER)) AS INTEGER) AS max_k
FROM events GROUP BY event_type""")
def event_props(spark, d):
    """SF21 / SF22: semi-structured props parsed to VARIANT, path access, typed extract."""
    ev = read_table(spark, d, "events").withColumn("v", F.try_parse_json("props"))
    k = F.try_variant_get("v", "$.k", "int")
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("events"),
        F.count(k).cast("bigint").alias("with_k"),
        F.avg(k).alias("avg_k"), F.max(k).alias("max_k"))
