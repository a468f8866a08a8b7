"""Upkeep queries: serving-copy export + reconciliation, pipeline run + lineage report."""

from __future__ import annotations

from pyspark.sql import functions as F

from wingspan.operators import installed_base as ib
from wingspan.operators import upkeep as U
from wingspan.operators.incremental import GoldTable, Measure
from wingspan.operators.security import lineage_closure as closure
from wingspan.operators.security import lineage_report as lineage_rep
from wingspan.plans import common as C
from wingspan.plans.registry import all_oracles, all_queries, query
from wingspan.plans.runner import PipelineRun
from wingspan.session import materialize, scratch_path
from wingspan.sources.bindings import AS_OF_DATE
from wingspan.sources.driver import read_table

G = "upkeep"
# Serving copies and their primary keys.
SERVING = {"component_health": ["component_id"], "customer_operations": ["airline"],
           "aircraft_health": ["tail_number"], "forecast_table": ["component_id"]}


@query("sync_reconcile", group=G, oracle="\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS source_rows, "
    f"CAST(count(*) AS BIGINT) AS copy_rows, true AS counts_equal FROM ({all_oracles()[n]})"
    for n in SERVING))
def sync_reconcile(spark, d):
    """SNK13 + SNK15: keyed snapshot exports of gold tables, then source vs copy counts."""
    root = scratch_path(spark, "serving")
    sources, copies = {}, {}
    for name, keys in SERVING.items():
        src = materialize(all_queries()[name](spark, d), name)  # read by the key check, the export and the counts
        path = f"{root}/{name}"
        U.export_snapshot(src, path, name, keys, secured={"row_filtered", "masked"})
        sources[name], copies[name] = src, spark.read.parquet(path)
    return U.reconcile(sources, copies)


def installed_base_pipeline(root: str) -> PipelineRun:
    """The installed-base medallion flow as declared datasets (bronze -> silver -> gold)."""
    p = PipelineRun(root)
    p.add("bronze_maintenance_records", ("maintenance",))(lambda r: ib.bronze(r, ib.RECORD_RULES))
    p.add("bronze_components_registry", ("components",))(lambda c: ib.bronze(c, ib.COMPONENT_RULES))
    p.add("bronze_aircraft_registry", ("ib_aircraft",))(lambda a: ib.bronze(a, ib.AIRCRAFT_RULES))
    p.add("bronze_customer_registry", ("airlines",))(lambda a: ib.bronze(a, ib.AIRLINE_RULES))
    p.add("silver_enriched_maintenance",
          ("bronze_maintenance_records", "bronze_components_registry", "bronze_aircraft_registry"),
          cluster_by=("airline", "component_type"))(ib.enrich_maintenance)
    p.add("bronze_component_telemetry", ("bronze_components_registry", "bronze_maintenance_records"))(
        lambda c, r: ib.bronze(ib.health_snapshot(c, r, AS_OF_DATE), ib.SNAPSHOT_RULES))
    p.add("gold_component_health",
          ("bronze_component_telemetry", "bronze_components_registry", "bronze_maintenance_records"),
          cluster_by=("airline", "failure_risk_category"))(ib.component_health)
    p.add("gold_maintenance_compliance", ("silver_enriched_maintenance",),
          cluster_by=("airline",))(ib.maintenance_compliance)
    p.add("gold_maintenance_anomalies", ("silver_enriched_maintenance",),
          cluster_by=("anomaly_type", "flight_delay_risk"))(ib.maintenance_anomalies)
    p.add("gold_customer_operations",
          ("bronze_customer_registry", "silver_enriched_maintenance", "bronze_component_telemetry"),
          cluster_by=("airline",))(ib.customer_operations)
    return p


@query("lineage_report", group=G)
def lineage_report(spark, d):
    """ST5 + SRC14 + SE5: full refresh of the installed-base pipeline, then its lineage."""
    from wingspan.sources.bindings import bound
    p = installed_base_pipeline(scratch_path(spark, "pipeline"))
    sources = {n: bound(spark, d, n) for n in ("maintenance", "components", "ib_aircraft", "airlines")}
    counts = p.run(spark, sources)
    rep = lineage_rep(p.lineage(spark), "gold_%",
                      "component|customer_operations|maintenance_(compliance|anomalies)")
    cnt = spark.createDataFrame(list(counts.items()), "target_table string, rows_written long")
    return rep.join(cnt, "target_table", "left").withColumn("last_seen", F.col("last_seen").cast("string"))


@query("lineage_closure", group=G, oracle=f"""
WITH RECURSIVE edge(s, t) AS (VALUES {", ".join(
    f"('{i}', '{n}')" for n, ds in installed_base_pipeline("").datasets.items() for i in ds.inputs)})
, reach(s, t, n) AS (SELECT s, t, 1 FROM edge
  UNION SELECT r.s, e.t, r.n + 1 FROM reach r JOIN edge e ON e.s = r.t)
SELECT s AS source_table, t AS target_table, CAST(min(n) AS BIGINT) AS steps FROM reach GROUP BY s, t""")
def lineage_closure(spark, d):
    """SRC14 + SE5: every table that a dataset of a full refresh comes from, by the edges that run recorded."""
    from wingspan.sources.bindings import bound
    p = installed_base_pipeline(scratch_path(spark, "pipeline"))
    p.run(spark, {n: bound(spark, d, n) for n in ("maintenance", "components", "ib_aircraft", "airlines")})
    return closure(p.lineage(spark))


CURVE_FILES = 16


@query("clustered_layout", group=G, oracle="""
WITH b AS (SELECT min(l_shipdate) AS d0, min(l_partkey) AS p0, max(l_partkey) AS p1 FROM lineitem)
SELECT 'l_shipdate' AS column_name, CAST(count(*) AS BIGINT) AS matching_rows, true AS half_skipped
FROM lineitem, b WHERE date_diff('day', CAST(d0 AS DATE), CAST(l_shipdate AS DATE)) < 100
UNION ALL SELECT 'l_partkey', CAST(count(*) AS BIGINT), true FROM lineitem, b WHERE (l_partkey - p0) * 20 <= p1 - p0""")
def clustered_layout(spark, d):
    """SNK4: line items clustered by date and part together; half the files or more are skipped for a filter on either.

    A file is skipped when its least value of the column is beyond the filter.
    """
    path = scratch_path(spark, "clustered")
    src = read_table(spark, d, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    U.cluster(src, ["l_shipdate", "l_partkey"], CURVE_FILES).write.mode("overwrite").parquet(path)
    t = spark.read.parquet(path)
    ends = t.agg(F.min("l_shipdate").alias("d0"), F.min("l_partkey").alias("p0"), F.max("l_partkey").alias("p1"))
    wanted = {"l_shipdate": F.date_diff("l_shipdate", ends.select("d0").scalar()) < 100,
              "l_partkey": (F.col("l_partkey") - ends.select("p0").scalar()) * 20
              <= ends.select("p1").scalar() - ends.select("p0").scalar()}
    files = t.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[F.min(c).alias(c) for c in wanted],
        *[F.count_if(w).cast("bigint").alias(f"{c}_rows") for c, w in wanted.items()])
    per = files.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_rows").alias("n"), (F.coalesce(w, F.lit(False)))
                 .alias("read")) for c, w in wanted.items()])).alias("f")).select("f.*")
    return per.groupBy("column_name").agg(F.sum("n").alias("matching_rows"),
                                          (F.count_if("read") * 2 <= F.count(F.lit(1))).alias("half_skipped"))


FLIGHT_GOLD = [Measure("n_records", "count", "1"), Measure("anomaly_records", "count", "anomaly_type"),
               Measure("max_altitude", "max", "altitude"), Measure("max_egt", "max", "greatest(egt_eng1, egt_eng2)"),
               Measure("min_hydraulic", "min", "least(hyd_press_sys1, hyd_press_sys2, hyd_press_sys3)"),
               Measure("avg_oil_pressure", "avg", "oil_pressure_eng1"),
               Measure("total_fuel_flow", "sum", "fuel_flow_eng1"), Measure("last_event", "max", "event_ts")]


@query("gold_refresh", group=G, oracle=C.TEL_PRE + """
, now AS (SELECT * REPLACE (CASE WHEN record_sequence = 2 THEN altitude + 10 ELSE altitude END AS altitude,
    CASE WHEN record_sequence = 2 THEN fuel_flow_eng1 * 0.5 ELSE fuel_flow_eng1 END AS fuel_flow_eng1)
  FROM clean WHERE record_sequence <> 3)
SELECT flight_id, CAST(count(*) AS BIGINT) AS n_records, CAST(count(anomaly_type) AS BIGINT) AS anomaly_records,
  round(max(altitude), 6) AS max_altitude, round(max(greatest(egt_eng1, egt_eng2)), 6) AS max_egt,
  round(min(least(hyd_press_sys1, hyd_press_sys2, hyd_press_sys3)), 6) AS min_hydraulic,
  round(CAST(sum(CAST(oil_pressure_eng1 AS DECIMAL(28, 6))) AS DOUBLE) / count(oil_pressure_eng1), 6) AS avg_oil_pressure,
  round(CAST(sum(CAST(fuel_flow_eng1 AS DECIMAL(28, 6))) AS DOUBLE), 6) AS total_fuel_flow, max(event_ts) AS last_event
FROM now GROUP BY flight_id""")
def gold_refresh(spark, d):
    """SNK3 + ST5: flight measures after a feed of new, changed and deleted records, refreshed and not recomputed.

    Stand-in feed: first records come with the second batch, second records change, third records go.
    """
    tel = C.telemetry(spark, d)
    seq = F.col("record_sequence")
    row, changed = F.struct(*tel.columns), F.struct(*[{
        "altitude": F.col("altitude") + 10, "fuel_flow_eng1": F.col("fuel_flow_eng1") * 0.5}.get(c, F.col(c)).alias(c)
        for c in tel.columns])
    none = F.lit(None).cast(tel.select(row.alias("r")).schema["r"].dataType)
    gold = GoldTable(spark, scratch_path(spark, "flight-gold"), ["flight_id"], FLIGHT_GOLD)
    gold.refresh(tel.filter(seq != 1).select(none.alias("before"), row.alias("after")), epoch=0)
    second = tel.filter(seq <= 3).select(F.when(seq == 1, none).otherwise(row).alias("before"),
                                         F.when(seq == 3, none).when(seq == 2, changed).otherwise(row).alias("after"))
    base = tel.filter(seq != 3).withColumns({
        "altitude": F.when(seq == 2, F.col("altitude") + 10).otherwise(F.col("altitude")),
        "fuel_flow_eng1": F.when(seq == 2, F.col("fuel_flow_eng1") * 0.5).otherwise(F.col("fuel_flow_eng1"))})
    gold.refresh(second, base, epoch=1)
    out = gold.table()
    return gold.full(tel.limit(0)) if out is None else out
