"""Unit tests on hand-made fixtures (nulls, ties, empty groups, zero denominators)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wingspan.functions.columns import qcut_decile
from wingspan.operators import evaluation as ev
from wingspan.operators import expectations as X
from wingspan.operators import installed_base as ib
from wingspan.operators import replay as rp
from wingspan.operators import search as S
from wingspan.operators import security as sec
from wingspan.operators import telemetry as tm
from wingspan.operators import text as T
from wingspan.operators.metrics import ANOMALY_METRICS
from wingspan.operators.ordering import global_cumsum, global_row_number

TS = dt.datetime(2001, 1, 1)


def test_expectations_drop_warn_fail(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, 3.0)], "id int, x double")
    rules = X.rules({"id_present": "id IS NOT NULL", "x_positive": "x >= 0"}, "drop")
    kept = X.apply_expectations(df, rules)
    assert sorted(r.id for r in kept.collect()) == [1]
    counts = {r.rule: r.violations for r in X.violation_counts(df, rules).collect()}
    assert counts == {"id_present": 1, "x_positive": 1}
    dropped = X.quarantine(df, rules, ["id"]).count()
    assert dropped + kept.count() == df.count()          # drop + kept = total
    warn = X.apply_expectations(df, X.rules({"x_positive": "x >= 0"}, "warn"))
    assert warn.count() == 3
    with pytest.raises(Exception):
        X.apply_expectations(df, X.rules({"x_positive": "x >= 0"}, "fail")).collect()


def test_null_predicate_counts_as_violation(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "x double")
    rules = X.rules({"x_positive": "x >= 0"}, "drop")
    assert X.apply_expectations(df, rules).count() == 1


def _enriched_rows(spark, rows):
    cols = ("flight_id long, record_sequence int, event_ts timestamp, flight_phase string, "
            "anomaly_type string, anomaly_severity string, airline string, tail_number long, "
            "aircraft_type string, oil_pressure_eng1 double, oil_pressure_eng2 double, "
            "engine_avg_egt double, engine_avg_vibration double")
    return spark.createDataFrame(rows, cols)


def test_peak_tie_break_and_oil_at_peak(spark):
    # two records with equal peak EGT: the earlier one wins (D1); oil is at the peak (D2)
    rows = [(1, 2, TS + dt.timedelta(seconds=10), "CRUISE", "EGT", "HIGH", "A", 7, "X", 50.0, 40.0, 900.0, 1.0),
            (1, 1, TS, "CLIMB", "EGT", "HIGH", "A", 7, "X", 30.0, 60.0, 900.0, 2.0),
            (1, 3, TS + dt.timedelta(seconds=20), "CRUISE", "EGT", "HIGH", "A", 7, "X", 10.0, 10.0, 800.0, 3.0)]
    for perm in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        out = tm.peak_events(_enriched_rows(spark, [rows[i] for i in perm])).collect()
        assert len(out) == 1
        r = out[0]
        assert r.flight_phase_at_peak == "CLIMB" and r.min_oil_pressure_during_event == 30.0
        assert r.event_duration_seconds == 20.0


def test_top_anomaly_alphabetical_tie(spark):
    df = spark.createDataFrame([("A", "ZETA"), ("A", "ALPHA"), ("A", "ZETA"), ("A", "ALPHA"), ("B", None)],
                               "airline string, anomaly_type string")
    out = {r.airline: r.top_anomaly_type for r in tm.top_anomaly_per_airline(df).collect()}
    assert out == {"A": "ALPHA"}


@pytest.mark.parametrize("n", [1, 2, 11, 37, 100, 164, 1640])
def test_qcut_decile_matches_pandas(spark, n):
    ranks = pd.Series(np.arange(1, n + 1))
    if n >= 10:
        expected = (pd.qcut(ranks, 10, labels=False) + 1).tolist()
    else:
        expected = None
    df = spark.range(1, n + 1).withColumn("d", qcut_decile(F.col("id"), F.lit(n)))
    got = [r.d for r in df.orderBy("id").collect()]
    if expected is not None:
        assert got == expected
    assert min(got) >= 1 and max(got) <= 10


def test_global_row_number_and_cumsum(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 50, 500).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v long").repartition(7)
    out = global_row_number(df, [F.col("v").desc(), F.col("id")], "rn", parts=5).toPandas()
    exp = sorted(range(500), key=lambda i: (-vals[i], i))
    assert out.sort_values("rn")["id"].tolist() == exp
    g = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    c = global_cumsum(g, [F.col("v").asc()], {"n": "n"}, parts=3).toPandas().sort_values("v")
    assert c["cum_n"].iloc[-1] == 500 and (np.diff(c["cum_n"]) > 0).all()


def _brute_auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, s):
    ap, p_tot = 0.0, sum(y)
    for t in sorted(set(s), reverse=True):
        sel = [yi for yi, si in zip(y, s) if si >= t]
        pos_at = sum(yi for yi, si in zip(y, s) if si == t)
        ap += (pos_at / p_tot) * (sum(sel) / len(sel))
    return ap


def test_auc_ap_capture_against_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 200).tolist()
    s = [float(x) for x in np.round(rng.random(200) + np.array(y) * 0.3, 1)]  # many ties
    df = spark.createDataFrame([(i, yi, si) for i, (yi, si) in enumerate(zip(y, s))],
                               "id long, y int, score double")
    assert ev.roc_auc(df).first().roc_auc == pytest.approx(_brute_auc(y, s), abs=1e-12)
    assert ev.average_precision(df).first().average_precision == pytest.approx(_brute_ap(y, s), abs=1e-12)
    k = math.ceil(0.1 * 200)
    top = sorted(range(200), key=lambda i: (-s[i], i))[:k]
    cap = ev.top_decile_capture(df, "id").first()
    assert cap.k == k and cap.caught == sum(y[i] for i in top)


def test_installed_base_rules(spark):
    rec = spark.createDataFrame(
        [("r1", 1, 10, dt.date(2001, 1, 5), "COMPLIANT", True, None, False, 91),
         ("r2", 1, 10, dt.date(2001, 2, 5), "COMPLIANT", True, "HIGH", True, 105),
         ("r3", 2, 10, dt.date(2001, 3, 5), "NON_COMPLIANT", False, None, False, 30)],
        "record_id string, component_id long, tail_number long, maintenance_date date, "
        "compliance_status string, anomaly_flag boolean, anomaly_severity string, "
        "warranty_claim_risk boolean, days_since_last_service long")
    for c, v in {"maintenance_type": "S", "mro_shop": "M", "cycles_at_service": 1, "is_overdue": False,
                 "anomaly_type": "T", "flight_delay_risk": "LOW", "days_undetected": 1}.items():
        rec = rec.withColumn(c, F.lit(v))
    comp = spark.createDataFrame([(1, "HYD", "d", "P", 90, 1000, 500, "FLIGHT_CRITICAL"),
                                  (2, "FUEL", "d", "P", 0, 1000, 700, "ESSENTIAL")],
                                 "component_id long, component_type string, description string, "
                                 "division string, maintenance_interval_days long, max_cycles long, "
                                 "unit_cost_usd long, criticality string")
    ac = spark.createDataFrame([(10, "AL01", "A320", 1990, 11, 100)],
                               "tail_number long, airline string, aircraft_type string, "
                               "manufacture_year long, age_years long, total_flight_hours long")
    e = {r.record_id: r for r in ib.enrich_maintenance(rec, comp, ac).collect()}
    assert e["r1"].anomaly_risk_flag is None                 # D7: true AND null -> null
    assert e["r2"].anomaly_risk_flag is True
    assert e["r1"].overdue_days == 1 and e["r2"].overdue_days == 15
    # D8: gap interval+1 is overdue without grace but not with the 14-day grace
    from wingspan.functions import scoring
    flags = ib.enrich_maintenance(rec, comp, ac).select(
        "record_id", scoring.overdue_with_grace().alias("g")).collect()
    assert {r.record_id: r.g for r in flags} == {"r1": False, "r2": True, "r3": True}
    assert e["r2"].record_warranty_exposure_usd == 500 and e["r1"].record_warranty_exposure_usd == 0
    assert e["r3"].compliance_score == 0.0                    # zero interval: no error (D18)
    assert e["r1"].compliance_score == pytest.approx(1 - min(91 / 135, 1) * 0.2)


def test_secure_never_leaks(spark):
    airlines = spark.createDataFrame([("AL01", "EUROPE", 1), ("AL02", "ASIA", 1)],
                                     "airline string, hub string, fleet_size long")
    data = spark.createDataFrame([(1, "AL01", 10.0), (2, "AL02", 20.0), (3, "AL01", 30.0)],
                                 "id long, airline string, money double")
    ents = sec.entitlements(spark, airlines)
    owner = sec.secure(data, ents, "platform_owner", [], masked=("money",)).collect()
    assert len(owner) == 3 and all(r.money is not None for r in owner)
    staff = sec.secure(data, ents, "x", ["field_service"], masked=("money",)).collect()
    assert len(staff) == 3 and all(r.money is None for r in staff)
    op = sec.secure(data, ents, "x", ["operator_al01"]).collect()
    assert {r.airline for r in op} == {"AL01"} and len(op) == 2
    assert sec.secure(data, ents, "stranger", []).count() == 0
    many = sec.secure_many(data, ents, [("x", ["operator_al02"]), ("stranger", [])]).collect()
    assert [(r.caller, r.airline) for r in many] == [("x", "AL02")]


def test_upsert_and_table_diff(spark):
    t = spark.createDataFrame([("a", "*", 1), ("b", "X", 2)], "p string, k string, v int")
    s = spark.createDataFrame([("b", "X", 9), ("c", "Y", 3)], "p string, k string, v int")
    out = sorted(tuple(r) for r in sec.upsert(t, s, ["p", "k"]).collect())
    assert out == [("a", "*", 1), ("b", "X", 9), ("c", "Y", 3)]
    d = X.table_diff(t, s).collect()
    assert {(r.p, r.side) for r in d} == {("a", "left_only"), ("b", "left_only"),
                                          ("b", "right_only"), ("c", "right_only")}


def test_quota_sample_exact(spark):
    rows = [(i, "BIG" if i < 300 else "SMALL") for i in range(310)]
    df = spark.createDataFrame(rows, "flight_id long, airline string")
    out = rp.quota_sample(df, "airline", "flight_id", 0.25).groupBy("airline").count().collect()
    got = {r.airline: r["count"] for r in out}
    assert got == {"BIG": round(300 * 0.25), "SMALL": round(10 * 0.25)}   # half-even: 2


def test_chunks_and_bm25_against_brute_force(spark):
    docs = spark.createDataFrame(
        [(1, "Title one\nthe pump leaks oil\n\nthe valve sticks", "en", "s"),
         (2, "Title two\nOil pressure drop in the pump", "en", "s")],
        "doc_id long, text string, lang string, source string")
    ch = T.chunk_fields(T.section_chunks(docs))
    assert sorted(r.chunk_id for r in ch.collect()) == ["1|0", "1|1", "1|3", "2|0", "2|1"]
    idx = S.SearchIndex.build(ch, materialize=False)
    q = spark.createDataFrame([(0, "oil pump")], "query_id int, query_text string")
    got = {tuple(r.chunk_key): r.score for r in idx.bm25(q).collect()}
    # brute force BM25 over the same tokens
    texts = {tuple(r.chunk_key): r.search_text.lower() for r in ch.collect()}
    import re
    toks = {k: [t for t in re.split(r"[^\w]+|_", v) if t] for k, v in texts.items()}
    n, avgdl = len(toks), sum(len(v) for v in toks.values()) / len(toks)
    exp = {}
    for k, tt in toks.items():
        sc = 0.0
        for term in ("oil", "pump"):
            df_ = sum(1 for v in toks.values() if term in v)
            tf = tt.count(term)
            if tf:
                idf = math.log((n - df_ + 0.5) / (df_ + 0.5) + 1)
                sc += idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(tt) / avgdl))
        if sc:
            exp[k] = sc
    assert set(got) == set(exp)
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)
    top = S.search(ch, "oil pump", k=2, mode="KEYWORD").collect()
    assert len(top) == 2 and top[0].rank == 1


def test_page_text(spark):
    pages = spark.createDataFrame([(1, "u", "<html><head><title>T &amp; x</title><script>var a='<p>';"
                                              "</script></head><body><!-- c --><p>Hi&nbsp;there &lt;3</p>"
                                              "</body></html>")], "page_id long, url string, html string")
    r = T.page_text(pages).first()
    assert r.title == "T &amp; x" or r.title == "T & x"
    assert r.full_text == "T & x Hi there <3" and r.parse_ok


def test_metric_view_filter_measures(spark):
    df = spark.createDataFrame([("A", "CRITICAL", "HIGH", True, 2, 5, 10),
                                ("A", "LOW", "LOW", False, 0, None, 0)],
                               "anomaly_type string, anomaly_severity string, flight_delay_risk string, "
                               "warranty_claim_risk boolean, overdue_days long, days_undetected long, "
                               "record_warranty_exposure_usd long").withColumn("is_overdue", F.lit(False))
    r = ANOMALY_METRICS.query(df, dims=["anomaly_type"]).first()
    assert (r.total_anomalies, r.critical_anomalies, r.high_delay_risk, r.warranty_risk_events) == (2, 1, 1, 1)
    assert r.avg_overdue_days == 2.0 and r.avg_days_undetected == 5.0
    with pytest.raises(KeyError):
        ANOMALY_METRICS.query(df, dims=["nope"])


def test_isolation_forest_flags_planted_outlier(spark):
    from wingspan.operators.models import isolation_forest
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (600, 2)))]
    rows.append((999, 25.0, -25.0))
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = isolation_forest(df, ["a", "b"], ["id"], trees=50).toPandas()
    assert len(out) == 601
    assert bool(out.loc[out.id == 999, "is_outlier"].iloc[0])
    assert 0.05 <= out.is_outlier.mean() <= 0.15
    assert out.anomaly_score.between(0, 1).all()


def test_group_lag_and_row_number_match_windows_with_hot_group(spark):
    from pyspark.sql import Window
    from wingspan.operators.ordering import group_lag, group_row_number
    rng = np.random.default_rng(5)
    rows = [(0 if i < 400 else int(rng.integers(1, 30)), int(rng.integers(0, 1000)), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g long, d long, id long").repartition(5)
    order = [F.col("d"), F.col("id")]
    w = Window.partitionBy("g").orderBy("d", "id")
    exp = df.withColumn("prev_d", F.lag("d").over(w)).withColumn("rn", F.row_number().over(w))
    exp = {r.id: (r.prev_d, r.rn) for r in exp.collect()}
    lag = {r.id: r.prev_d for r in group_lag(df, ["g"], order, ["d"], parts=4).collect()}
    rn = {r.id: r.rn for r in group_row_number(df, ["g"], order, "rn", parts=4).collect()}
    assert {k: (lag[k], rn[k]) for k in exp} == exp


def test_tasks_after_a_shuffle_read_a_quarter_of_the_default(spark):
    """the job settings bound what one task of a join or an aggregate takes into memory."""
    from wingspan.session import JOB_CONF, apply_job_conf
    fresh = spark.newSession()
    apply_job_conf(fresh)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert JOB_CONF[key] == "16m" and fresh.conf.get(key) == "16m"
    fresh.conf.set(key, "8m")  # a value the caller has set stays
    apply_job_conf(fresh)
    assert fresh.conf.get(key) == "8m"
