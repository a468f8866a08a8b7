"""Security queries: row filter, column mask, entitlement upsert (SE1-SE3, SNK11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wingspan.operators import policies as P
from wingspan.operators import security as sec
from wingspan.plans import common as C
from wingspan.plans.feature_plans import PIT_PRE, forecast
from wingspan.plans.registry import query
from wingspan.session import scratch_path

G = "security"

# The callers exercised by the security queries.
CALLERS = [("platform_owner", []), ("someone", ["field_service"]),
           ("planner", ["operator_al03"]), ("stranger", [])]

_ENTS_SQL = "ents AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{p}', '{t}', '{a}', {str(m).lower()})" for p, t, a, m in sec.PLATFORM_ENTITLEMENTS) + \
    ") v(principal, principal_type, airline, can_see_financials) UNION ALL " \
    "SELECT 'operator_' || lower(airline), 'GROUP', airline, false FROM al)"


def _callers_sql():
    rows = []
    for caller, groups in CALLERS:
        garr = "[" + ", ".join(f"'{g}'" for g in groups) + "]::VARCHAR[]"
        rows.append(f"('{caller}', {garr})")
    return "callers AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") v(caller, caller_groups))"


def _by_caller(spark, d, df, masked=()):
    al = C.airlines(spark, d)
    ents = sec.entitlements(spark, al)
    return sec.secure_many(df, ents, CALLERS, masked=masked)


@query("row_filtered", group=G, oracle=PIT_PRE + f", {_ENTS_SQL}, {_callers_sql()}" + """
SELECT c.caller, f.component_id, f.airline, f.risk_decile FROM fct f, callers c
WHERE EXISTS (SELECT 1 FROM ents e WHERE (e.airline = '*' OR e.airline = f.airline)
  AND ((e.principal_type = 'USER' AND e.principal = c.caller)
    OR (e.principal_type = 'GROUP' AND list_contains(c.caller_groups, e.principal))))""")
def row_filtered(spark, d):
    """SE1 / JN17: the forecast table as seen by four callers (owner, staff, operator, stranger)."""
    f = forecast(spark, d).select("component_id", "airline", "risk_decile")
    return _by_caller(spark, d, f)


@query("masked", group=G, oracle=PIT_PRE + f", {_ENTS_SQL}, {_callers_sql()}" + """
SELECT c.caller, f.airline, CAST(count(*) AS BIGINT) AS components,
  round(sum(CASE WHEN EXISTS (SELECT 1 FROM ents e WHERE e.can_see_financials
      AND ((e.principal_type = 'USER' AND e.principal = c.caller)
        OR (e.principal_type = 'GROUP' AND list_contains(c.caller_groups, e.principal))))
    THEN f.expected_warranty_exposure_usd END), 6) AS expected_exposure_usd
FROM fct f, callers c
WHERE EXISTS (SELECT 1 FROM ents e WHERE (e.airline = '*' OR e.airline = f.airline)
  AND ((e.principal_type = 'USER' AND e.principal = c.caller)
    OR (e.principal_type = 'GROUP' AND list_contains(c.caller_groups, e.principal))))
GROUP BY c.caller, f.airline""")
def masked(spark, d):
    """SE2 / JN18: financial column masked by caller, then rolled up per airline."""
    f = forecast(spark, d).select("component_id", "airline", "expected_warranty_exposure_usd")
    s = _by_caller(spark, d, f, masked=("expected_warranty_exposure_usd",))
    return s.groupBy("caller", "airline").agg(
        F.count(F.lit(1)).cast("bigint").alias("components"),
        F.sum("expected_warranty_exposure_usd").alias("expected_exposure_usd"))


@query("entitlement_upsert", group=G, oracle=C.IB_PRE + f", {_ENTS_SQL}" + """
, src AS (SELECT 'operator_' || lower(airline) AS principal, 'GROUP' AS principal_type, airline,
    true AS can_see_financials FROM al WHERE hub = 'EUROPE'
  UNION ALL SELECT 'auditors', 'GROUP', '*', false)
SELECT * FROM ents e WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.principal = e.principal
  AND s.airline = e.airline)
UNION ALL SELECT * FROM src""")
def entitlement_upsert(spark, d):
    """SE3 / SNK11: MERGE of entitlement updates on (principal, airline)."""
    al = C.airlines(spark, d)
    ents = sec.entitlements(spark, al)
    src = al.filter(F.col("hub") == "EUROPE").select(
        F.concat(F.lit("operator_"), F.lower("airline")).alias("principal"),
        F.lit("GROUP").alias("principal_type"), "airline", F.lit(True).alias("can_see_financials"))
    src = src.unionByName(spark.createDataFrame([("auditors", "GROUP", "*", False)],
                                                sec.ENTITLEMENT_SCHEMA))
    return sec.upsert(ents, src, ["principal", "airline"])


MONEY = "expected_warranty_exposure_usd"


def governed(spark, d) -> str:
    """A database with the forecast and the airlines as tables, their policies set on them; returns its name."""
    db = f"governed_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'governed')}'")
    forecast(spark, d).select("component_id", "airline", "risk_decile", MONEY).write.saveAsTable(f"{db}.forecast")
    C.airlines(spark, d).write.saveAsTable(f"{db}.airlines")
    P.set_policy(spark, f"{db}.forecast", "row_filter", "airline")
    P.set_policy(spark, f"{db}.forecast", "column_mask", MONEY)
    P.set_policy(spark, f"{db}.airlines", "row_filter", "airline")
    return db


@query("governed_read", group=G, oracle=PIT_PRE + f", {_ENTS_SQL}, {_callers_sql()}" + f"""
SELECT c.caller, f.component_id, f.airline, f.risk_decile, round(CASE WHEN EXISTS (SELECT 1 FROM ents e
    WHERE e.can_see_financials AND ((e.principal_type = 'USER' AND e.principal = c.caller)
      OR (e.principal_type = 'GROUP' AND list_contains(c.caller_groups, e.principal))))
  THEN f.{MONEY} END, 6) AS {MONEY}
FROM fct f, callers c
WHERE EXISTS (SELECT 1 FROM ents e WHERE (e.airline = '*' OR e.airline = f.airline)
  AND ((e.principal_type = 'USER' AND e.principal = c.caller)
    OR (e.principal_type = 'GROUP' AND list_contains(c.caller_groups, e.principal))))""")
def governed_read(spark, d):
    """SE1 + SE2 + UD1 + UD2: the stored forecast as four callers see it, by the policies found on the table."""
    db = governed(spark, d)
    return P.read_secured_many(spark, f"{db}.forecast", sec.entitlements(spark, C.airlines(spark, d)), CALLERS)


@query("policy_inventory", group=G, oracle=C.IB_PRE + f"""
, t AS (SELECT * FROM (VALUES ('set', 'forecast', 'row_filter', 'airline', 'airline_row_filter'),
    ('set', 'forecast', 'column_mask', '{MONEY}', 'financial_mask'),
    ('set', 'airlines', 'row_filter', 'airline', 'airline_row_filter'),
    ('dropped', 'forecast', 'row_filter', 'airline', 'airline_row_filter'),
    ('dropped', 'airlines', 'row_filter', 'airline', 'airline_row_filter')) v(phase, table_name, kind, column_name, function))
SELECT t.*, CAST((SELECT count(*) FROM al) + 3 AS BIGINT) AS principals,
  CAST(CASE kind WHEN 'column_mask' THEN 2 ELSE 3 END AS BIGINT) AS unrestricted FROM t""")
def policy_inventory(spark, d):
    """SE4 + SRC13: the policies found on the tables, before and after the forecast's mask is dropped."""
    db = governed(spark, d)
    ents = sec.entitlements(spark, C.airlines(spark, d))
    before = P.inventory(spark, db, ents)
    P.drop_policy(spark, f"{db}.forecast", "column_mask", MONEY)
    after = P.inventory(spark, db, ents)
    return before.select(F.lit("set").alias("phase"), "*").unionByName(after.select(F.lit("dropped").alias("phase"), "*"))
