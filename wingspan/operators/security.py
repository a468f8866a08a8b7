"""Row filters, column masks, entitlement upserts, lineage (SE1-SE5, UD1-UD2, SNK11).

Open-source Spark has no catalog row filters, so ``secure()`` wraps a
DataFrame for a caller:

* the caller's entitlement rows are resolved first (user, or any group);
* a ``*`` entitlement lets every row through, whatever its airline (null
  and unlisted ones too); the other grants are an equi-join on ``airline``
  (hash join), not a nested loop over ``(e.airline = '*' OR e.airline = airline)``;
* masked columns become NULL unless an entitlement grants financials.

The row filter and the column mask (UD1, UD2) are also provided as
``CREATE TEMPORARY FUNCTION`` text for callers that prefer SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITLEMENT_SCHEMA = "principal string, principal_type string, airline string, can_see_financials boolean"

# Platform principals of the entitlement map ('*' = all operators).
PLATFORM_ENTITLEMENTS = [
    ("platform_owner", "USER", "*", True),
    ("aftermarket_leads", "GROUP", "*", True),
    ("field_service", "GROUP", "*", False),
]


def entitlements(spark: SparkSession, airlines: DataFrame) -> DataFrame:
    """Platform rows plus one operator group per airline (own fleet, no money)."""
    fixed = spark.createDataFrame(PLATFORM_ENTITLEMENTS, ENTITLEMENT_SCHEMA)
    ops = airlines.select(F.concat(F.lit("operator_"), F.lower("airline")).alias("principal"),
                          F.lit("GROUP").alias("principal_type"), F.col("airline"),
                          F.lit(False).alias("can_see_financials"))
    return fixed.unionByName(ops)


def caller_entitlements(ents: DataFrame, caller: str, groups: list[str]) -> DataFrame:
    user = (F.col("principal_type") == "USER") & (F.col("principal") == F.lit(caller))
    if not groups:
        return ents.filter(user)
    return ents.filter(user | ((F.col("principal_type") == "GROUP") & F.col("principal").isin(list(groups))))


def sees_every_row(ents: DataFrame, caller: str, groups: list[str]) -> Column:
    """Whether the caller holds a ``*`` grant, as a scalar subquery."""
    mine = caller_entitlements(ents, caller, groups)
    return mine.select(F.count_if(F.col("airline") == "*") > 0).scalar()


def can_see_financials(ents: DataFrame, caller: str, groups: list[str]) -> Column:
    """JN18: uncorrelated EXISTS as a scalar subquery."""
    mine = caller_entitlements(ents, caller, groups)
    return mine.select(F.count_if(F.col("can_see_financials")) > 0).scalar()


def secure(df: DataFrame, ents: DataFrame, caller: str, groups: list[str],
           airline_col: str = "airline", masked: tuple[str, ...] = ()) -> DataFrame:
    """SE1 + SE2: rows of permitted airlines only, financial columns masked."""
    direct = (caller_entitlements(ents, caller, groups).filter(F.col("airline") != "*")
              .select(F.col("airline").alias("_granted")).distinct())
    out = df.join(direct, F.col(airline_col) == F.col("_granted"), "left").filter(
        sees_every_row(ents, caller, groups) | F.col("_granted").isNotNull())
    if masked:
        see = can_see_financials(ents, caller, groups)
        out = out.withColumns({c: F.when(see, F.col(c)) for c in masked})
    return out.select(*df.columns)


def caller_grants(ents: DataFrame, callers: list[tuple[str, list[str]]]) -> DataFrame:
    """(caller, airlines, every, _see): the grants of each caller, one row each.

    Each caller's principals (the user and its groups) are joined to the
    entitlements; ``every`` marks a ``*`` grant, money visibility is
    ``max(can_see)`` per caller.
    """
    spark = ents.sparkSession
    rows = [(c, c, "USER") for c, _ in callers] + [(c, g, "GROUP") for c, gs in callers for g in gs]
    who = spark.createDataFrame(rows, "caller string, principal string, principal_type string").distinct()
    mine = who.join(ents, ["principal", "principal_type"])
    return mine.groupBy("caller").agg(
        F.collect_set(F.when(F.col("airline") != "*", F.col("airline"))).alias("airlines"),
        F.bool_or(F.col("airline") == "*").alias("every"),
        F.bool_or(F.coalesce("can_see_financials", F.lit(False))).alias("_see"))


def secure_many(df: DataFrame, ents: DataFrame, callers: list[tuple[str, list[str]]],
                airline_col: str = "airline", masked: tuple[str, ...] = ()) -> DataFrame:
    """SE1 + SE2 for several callers in one pass over ``df``.

    Callers with a ``*`` grant see every row: the rows carry the (small,
    caller-given) list of them and explode it.  The others are joined on
    the airlines they are granted.
    """
    grants = caller_grants(ents, callers)
    star = (grants.filter("every").agg(F.collect_list(F.struct("caller", "_see"))).scalar())
    rows = df.withColumn("_c", F.explode(star)).select("_c.caller", "_c._see", *df.columns)
    direct = grants.filter("NOT every").select("caller", "_see", F.explode("airlines").alias("_granted"))
    some = df.join(direct, F.col(airline_col) == F.col("_granted")).select("caller", "_see", *df.columns)
    out = rows.unionByName(some)
    if masked:
        out = out.withColumns({c: F.when(F.col("_see"), F.col(c)) for c in masked})
    return out.select("caller", *df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """SNK11 / SE3: MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def export_guard(table_name: str, secured_tables: set[str]) -> None:
    """SNK14: refuse to export a table that carries a row filter or mask."""
    if table_name in secured_tables:
        raise PermissionError(f"{table_name} has a row filter or column mask; refusing to export")


# The filters and masks put on shared tables.
SECURED = [
    ("forecast_table", "row_filter", "airline", "airline_row_filter"),
    ("forecast_table", "column_mask", "expected_warranty_exposure_usd", "financial_mask"),
    ("customer_operations", "row_filter", "airline", "airline_row_filter"),
]


def security_inventory(ents: DataFrame) -> DataFrame:
    """SE4: filters and masks in force, all principals, and those that see every airline (or its money)."""
    rows = ents.sparkSession.createDataFrame(SECURED, "table_name string, kind string, column_name string, function string")
    star = F.col("airline") == "*"
    n = ents.agg(F.count(F.lit(1)).cast("bigint").alias("principals"), F.count_if(star).cast("bigint").alias("every"),
                 F.count_if(star & F.col("can_see_financials")).cast("bigint").alias("money"))
    every = F.when(F.col("kind") == "column_mask", n.select("money").scalar()).otherwise(n.select("every").scalar())
    return rows.select("*", n.select("principals").scalar().alias("principals"), every.alias("every_airline"))


def lineage_report(edges: DataFrame, target_like: str, pattern: str) -> DataFrame:
    """SE5 (AG19 + FLT7): source -> target pairs with the last time seen."""
    return (edges.filter(F.col("target_table").like(target_like)
                         & (F.col("target_table").rlike(pattern) | F.col("source_table").rlike(pattern))
                         & F.col("source_table").isNotNull())
            .groupBy("source_table", "target_table", "entity_type")
            .agg(F.max("event_time").alias("last_seen"))
            .orderBy("target_table", "source_table"))


def lineage_closure(edges: DataFrame) -> DataFrame:
    """SRC14 / SE5: every (source, target) that edges lead between, with the least number of steps.

    A recursive common table expression follows the distinct edges; a path
    never enters a table twice, so cycles end (a table on one leads to
    itself).  Edges with a null end take no part.  Spark's own limits on
    recursion stop a graph that is too deep or wide with an error.
    """
    view = f"_edges_{uuid.uuid4().hex[:12]}"
    (edges.select("source_table", "target_table").dropna().distinct().createOrReplaceTempView(view))
    return edges.sparkSession.sql(f"""
WITH RECURSIVE reach(source_table, target_table, steps, path) AS (
  SELECT source_table, target_table, 1, array(target_table) FROM {view}
  UNION ALL
  SELECT r.source_table, e.target_table, r.steps + 1, concat(r.path, array(e.target_table))
  FROM reach r JOIN {view} e ON e.source_table = r.target_table
  WHERE NOT array_contains(r.path, e.target_table))
SELECT source_table, target_table, CAST(min(steps) AS BIGINT) AS steps
FROM reach GROUP BY source_table, target_table""")


ROW_FILTER_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION airline_row_filter(airline STRING, caller STRING,
  caller_groups ARRAY<STRING>)
RETURNS BOOLEAN
RETURN EXISTS (SELECT 1 FROM operator_entitlements e
  WHERE (e.airline = '*' OR e.airline = airline_row_filter.airline)
    AND ((e.principal_type = 'USER' AND e.principal = caller)
      OR (e.principal_type = 'GROUP' AND array_contains(caller_groups, e.principal))))"""

COLUMN_MASK_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION financial_mask(amount DOUBLE, caller STRING, caller_groups ARRAY<STRING>)
RETURNS DOUBLE
RETURN CASE WHEN EXISTS (SELECT 1 FROM operator_entitlements e WHERE e.can_see_financials
    AND ((e.principal_type = 'USER' AND e.principal = caller)
      OR (e.principal_type = 'GROUP' AND array_contains(caller_groups, e.principal))))
  THEN amount END"""
