"""Joins and numberings that move only the rows and columns that they need."""

from pyspark.sql import functions as F

from wingspan.operators import replay as rp
from wingspan.operators import telemetry as tm

SENSORS = ["egt_eng1", "egt_eng2", "vibration_n1_eng1", "vibration_n1_eng2", "vibration_n2_eng1", "vibration_n2_eng2",
           "fuel_flow_eng1", "fuel_flow_eng2", "hyd_press_sys1", "hyd_press_sys2", "hyd_press_sys3"]


def _records(spark, rows):
    df = spark.createDataFrame(rows, "flight_id long, record_sequence int, flight_phase string")
    return df.withColumns({"event_ts": F.lit("2001-01-01").cast("timestamp"), **{c: F.lit(1.0) for c in SENSORS}})


def test_window_numbers_only_the_records_it_may_cover(spark, monkeypatch):
    rows = [(f, s, p) for f in (1, 2, None) for p in ("CRUISE", "CLIMB", None) for s in range(5)]
    numbered, whole = [], rp.group_row_number
    monkeypatch.setattr(rp, "group_row_number", lambda df, *a, **k: numbered.append(df.count()) or whole(df, *a, **k))
    targets = spark.createDataFrame([(1,), (None,)], "flight_id long")
    out = rp.inject_window(_records(spark, rows), targets).collect()
    assert numbered == [10] and len(out) == len(rows)  # flight 1 in the phase or without one
    hits = sorted((r.flight_id, r.flight_phase, r.record_sequence, r.egt_eng1) for r in out if r.injected)
    assert hits == [(1, "CRUISE", s, 46.0) for s in (0, 1, 2)]
    assert {r.injected for r in out if r.flight_phase == "CLIMB" or r.flight_id != 1} == {False}


def test_records_join_once(spark):
    flights = spark.createDataFrame([(1, 7, "A"), (1, 7, "B"), (2, None, "C")], "flight_id long, tail_number long, origin string")
    flights = flights.withColumns({"destination": F.lit("D"), "departure_time": F.lit("2001-01-01").cast("timestamp"),
                                   "has_anomaly": F.lit(False)})
    registry = spark.createDataFrame([(7, "X"), (7, "Y"), (None, "Z")], "tail_number long, airline string").withColumns(
        {c: F.lit(1) for c in tm.REGISTRY_COLS[2:]})
    out = tm.enrich_telemetry(_records(spark, [(1, 1, "CRUISE"), (2, 1, "CRUISE"), (3, 1, "CLIMB")]), flights, registry)
    assert out.columns[:4] == ["tail_number", "flight_id", "record_sequence", "flight_phase"]
    got = sorted((r.flight_id, r.tail_number or 0, r.origin or "", r.airline or "") for r in out.collect())
    assert got == [(1, 7, "A", "X"), (1, 7, "A", "Y"), (1, 7, "B", "X"), (1, 7, "B", "Y"), (2, 0, "C", ""), (3, 0, "", "")]
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert "flight_id" in joins[0] and "tail_number" in joins[1]


def test_clustering_works_its_rows_out_once(spark, tmp_path):
    from wingspan.operators import upkeep as U
    times = spark.sparkContext.accumulator(0)

    def counted(it):
        for batch in it:
            times.add(batch.num_rows)
            yield batch
    rows = spark.range(64, numPartitions=2).selectExpr("id AS a", "CAST(id % 8 AS STRING) AS b")
    out = U.cluster(rows.mapInArrow(counted, "a long, b string"), ["a"], 4)
    out.write.parquet(str(tmp_path / "one"))
    assert times.value == 64 and spark.read.parquet(str(tmp_path / "one")).count() == 64
    key = U.curve_key(rows, ["a", "b"], 3)
    both = U._with_curve_key(rows, ["a", "b"], "_k", 3).withColumn("_want", key)
    assert both.filter("_k <> _want OR _k IS NULL").count() == 0 and both.select("_k").distinct().count() > 8
