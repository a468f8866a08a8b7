import pytest
from pyspark.sql import functions as F

from wingspan.functions import scoring
from wingspan.operators import manuals as MN
from wingspan.operators.expectations import assert_unique

BODY = """Manual A
Engine: CFM 56.
TASK 12-34-56 Check
   pump Fault Code: none
 Fault Code: F1
Aircraft Type: A320
ATA Chapter: 12
System: fuel
  system
Part Name: pump
Part Number: P-1
Related Parts: seal,
 ring
Symptoms: noise
Probable Causes: wear
Limits: 3 mm
Corrective Action:
 Step 1. Remove
   pump
 Step 2. Fit pump
Torque Values: 20 Nm
Return to Service: run
TASK 12-34-57 Other
Aircraft Type: B737
"""


def test_all_labels_steps_and_sections(spark):
    df = spark.createDataFrame([("m.txt", "/m", BODY), ("n.txt", "/n", "no task"), ("o.txt", "/o", None)],
                               "manual_name string, source_path string, full_text string")
    got = {r.chunk_id: r for r in MN.manual_chunks(df).collect()}
    assert set(got) == {"A320|12-34-56", "B737|12-34-57"} and len(MN.manual_chunks(df).columns) == 19
    r = got["A320|12-34-56"]
    assert (r.engine, r.system, r.related_parts, r.limits) == ("CFM 56", "fuel system", "seal, ring", "3 mm")
    assert r.corrective_steps == "Remove pump\nFit pump" and r.torque_values == "20 Nm"
    o = got["B737|12-34-57"]
    assert o.fault_code is None and o.symptoms == "" and o.corrective_steps == ""
    sections = MN.task_sections(df).filter("section = 1")
    labels = sections.select(*[MN.labelled(F.col("content"), x).alias(x) for x in MN.LABELS]).first()
    assert labels["Return to Service"] == "run" and labels["ATA Chapter"] == "12"


def test_fail_rule_stops_on_a_duplicate_key(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert assert_unique(ok, ["id"], "grain").count() == 2
    with pytest.raises(Exception, match="expectation grain failed"):
        assert_unique(ok.unionByName(ok.limit(1)), ["id"], "grain").collect()


def test_rule_priority_by_hand(spark):
    df = spark.createDataFrame([(0.5, "Atlas Pacific", 20.0, 90), (None, "x", None, None), (0.0, "Summit Aviation", 0.0, 0)],
                               "rate double, airline string, health double, days int")
    p = scoring.rule_anomaly_probability(F.col("rate"), F.col("airline"))
    s = scoring.rule_priority(p, F.col("health"), F.col("days"))
    got = df.select(p.alias("p"), s.alias("s"), scoring.rule_priority_tier(s).alias("t")).collect()
    assert [(round(r.p, 6), round(r.s, 6), r.t) for r in got] == [
        (1.0, 60.0, "HIGH"), (0.0, 4.0, "LOW"), (0.0, 4.0, "LOW")]


def test_latest_flights_are_scored_by_the_fitted_trees(spark):
    from wingspan.operators import models as M
    rows = []
    for i in range(300):
        hot = i % 4 == 0
        row = [900.0 + i % 7 if hot else 500.0 + i % 11] * len(M.FLIGHT_FEATURES)
        row[0] = None if i % 5 == 0 else row[0]
        rows.append((f"t{i % 8}", i, hot if i != 1 else None, *row))
    flights = spark.createDataFrame(rows, "tail_number string, flight_id long, has_anomaly boolean, "
                                    + ", ".join(f"{c} double" for c in M.FLIGHT_FEATURES))
    # the last flight of t0 has no features but the first, so those of the flight before stand
    flights = flights.unionByName(spark.createDataFrame([("t0", 999, 1.0)], "tail_number string, flight_id long, "
                                                        "flight_duration_hours double"), allowMissingColumns=True)
    model, held = M.flight_anomaly_model(flights, maxIter=10)
    held = held.collect()
    assert {r.actual for r in held} == {0, 1} and 55 <= len(held) <= 65
    assert sum(r.actual == r.predicted for r in held) >= len(held) - 1
    got = {r.tail_number: r for r in M.latest_scores(flights, model, ["flight_id"]).collect()}
    assert len(got) == 8 and got["t0"].flight_duration_hours == 1.0
    for t, r in got.items():
        assert (r.ml_anomaly_probability > 0.5) == (t in ("t0", "t4")), (t, r)
