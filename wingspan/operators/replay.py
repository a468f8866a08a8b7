"""Telemetry re-processing jobs (RP1-RP6).

All steps are joins, windows and projections over whole tables; the
quota sample numbers rows with the distributed global numbering so a hot
airline is never one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wingspan.operators.ordering import global_row_number, group_row_number, join_null_safe

# Signature injected by the replay (RP2).
INJECT_PHASE = "CRUISE"
INJECT_START = 1
INJECT_LEN = 2
EGT_BUMP = 45.0
VIBRATION_FACTOR = 1.8
QUOTA_RATE = 0.25


def template_mapping(flights: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Flights without records get the lowest-id flight with records on the same route."""
    has = flights.join(telemetry.select("flight_id"), "flight_id", "left_semi")
    tmpl = has.groupBy("origin", "destination").agg(F.min("flight_id").alias("template_flight_id"))
    missing = flights.join(telemetry.select("flight_id"), "flight_id", "left_anti")
    return missing.join(tmpl, ["origin", "destination"], "inner").select("flight_id", "template_flight_id")


def clone_records(telemetry: DataFrame, mapping: DataFrame) -> DataFrame:
    """RP1 / JN11: copy template records under the new flight ids (fan-out join, rename)."""
    t = telemetry.withColumnRenamed("flight_id", "template_flight_id")
    return mapping.join(t, "template_flight_id", "inner")


def retime(records: DataFrame, flights: DataFrame) -> DataFrame:
    """RP3 / WN5 / SF10: move each flight to its departure time, keep offsets (microseconds)."""
    firsts = records.groupBy("flight_id").agg(F.min("event_ts").alias("_first"))
    r = records.join(firsts, "flight_id").withColumn(
        "_off", F.timestamp_diff("MICROSECOND", F.col("_first"), F.col("event_ts"))).drop("_first")
    r = r.join(flights.select("flight_id", "departure_time"), "flight_id", "left")
    new_ts = F.timestamp_add("MICROSECOND", F.col("_off"), F.col("departure_time"))
    return r.withColumn("event_ts", new_ts).withColumn("event_date", F.to_date("event_ts")) \
        .drop("_off", "departure_time")


def inject_window(telemetry: DataFrame, targets: DataFrame) -> DataFrame:
    """RP2 / WN4 / FLT6 / PRJ9: bump EGT and scale vibration in a phase window.

    The window covers positions ``start .. start + len`` inclusive (D16).
    Positions count records of the phase in sequence order (ties broken by
    the sensor values so the choice is deterministic).
    """
    order = [F.col(c) for c in ("record_sequence", "event_ts", "egt_eng1", "egt_eng2",
                                "vibration_n1_eng1", "vibration_n1_eng2")]
    t = telemetry.join(targets.select("flight_id").withColumn("_target", F.lit(True)), "flight_id", "left")
    # only records that the window may cover are numbered
    target = F.coalesce(F.col("_target"), F.lit(False))
    inside = target & F.coalesce(F.col("flight_phase") == INJECT_PHASE, F.lit(True))
    numbered = group_row_number(t.filter(inside), ["flight_id", "flight_phase"], order, "_idx")
    t = t.filter(~inside).withColumn("_idx", F.lit(None).cast("bigint")).unionByName(numbered)
    hit = target & (F.col("flight_phase") == INJECT_PHASE) & F.col("_idx").between(
        INJECT_START, INJECT_START + INJECT_LEN)
    return t.withColumns({
        "egt_eng1": F.when(hit, F.col("egt_eng1") + EGT_BUMP).otherwise(F.col("egt_eng1")),
        "egt_eng2": F.when(hit, F.col("egt_eng2") + EGT_BUMP).otherwise(F.col("egt_eng2")),
        "vibration_n1_eng1": F.when(hit, F.col("vibration_n1_eng1") * VIBRATION_FACTOR)
        .otherwise(F.col("vibration_n1_eng1")),
        "vibration_n1_eng2": F.when(hit, F.col("vibration_n1_eng2") * VIBRATION_FACTOR)
        .otherwise(F.col("vibration_n1_eng2")),
        "injected": hit,
    }).drop("_target", "_idx")


def adjust_by_group(registry: DataFrame, offsets: DataFrame, key: str = "airline") -> DataFrame:
    """RP4: per-group age shift with a floor of 1 year, dates moved by whole years."""
    r = registry.join(offsets, key, "left").withColumn("offset_years",
                                                       F.coalesce("offset_years", F.lit(0)))
    return r.withColumns({
        "aircraft_age_years": F.greatest(F.col("aircraft_age_years") - F.col("offset_years"), F.lit(1)),
        "last_maintenance_date": F.add_months("last_maintenance_date", -F.col("offset_years") * 12),
    })


def quota_sample(df: DataFrame, group: str, key: str, rate: float = QUOTA_RATE) -> DataFrame:
    """RP5: exactly bround(n x rate) rows per group, chosen in md5(key) order.

    Numbering uses the distributed global row number over (group, md5, key)
    and rebases each group on its first number: no window holds a group.
    """
    h = df.withColumn("_h", F.md5(F.col(key).cast("string")))
    n = global_row_number(h, [F.col(group), F.col("_h"), F.col(key)], "_grn", reuse=True)
    g = n.groupBy(group).agg(F.min("_grn").alias("_first"), F.count(F.lit(1)).alias("_n"))
    j = join_null_safe(n, g, [group])
    quota = F.bround(F.col("_n") * F.lit(rate), 0)
    return j.filter(F.col("_grn") - F.col("_first") + 1 <= quota).drop("_h", "_grn", "_first", "_n")


def extend_events(events: DataFrame) -> DataFrame:
    """RP6 / UN2: add a landing-phase follow-up for HIGH/CRITICAL events, union by name."""
    lands = (events.filter(F.col("anomaly_severity").isin("HIGH", "CRITICAL"))
             .withColumns({
                 "flight_phase_at_peak": F.lit("APPROACH_LANDING"),
                 "peak_egt": F.col("peak_egt") * 0.9,
                 "event_start_timestamp": F.timestamp_add(
                     "SECOND", F.col("event_duration_seconds").cast("bigint"),
                     F.col("event_start_timestamp")),
                 "event_duration_seconds": F.lit(0.0)}))
    return events.withColumn("derived", F.lit(False)).unionByName(
        lands.withColumn("derived", F.lit(True)))
