"""Policies on tables: applied at each read, listed as they stand, closed where they cannot be applied."""

import uuid

import pytest

from wingspan.operators import policies as P
from wingspan.operators import security as sec

CALLERS = [("platform_owner", []), ("x", ["field_service"]), ("y", ["operator_al01"]), ("stranger", [])]


@pytest.fixture()
def db(spark, tmp_path):
    name = f"pol_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    data = spark.createDataFrame([(1, "AL01", 5.0), (2, "AL02", 7.0), (3, None, None)],
                                 "id int, airline string, `money.usd` double")
    data.write.saveAsTable(f"{name}.fleet")
    data.filter("false").write.saveAsTable(f"{name}.none")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="module")
def ents(spark):
    return sec.entitlements(spark, spark.createDataFrame([("AL01",), ("AL02",)], "airline string"))


def _seen(spark, table, ents):
    out = {c: [] for c, _ in CALLERS}
    for r in P.read_secured_many(spark, table, ents, CALLERS).collect():
        out[r.caller].append((r.id, r["money.usd"]))
    return {c: sorted(v) for c, v in out.items()}


def test_reads_follow_the_policies_in_force(spark, db, ents):
    t, every = f"{db}.fleet", [(1, 5.0), (2, 7.0), (3, None)]
    hidden = [(i, None) for i, _ in every]
    assert set(map(tuple, _seen(spark, t, ents).values())) == {tuple(every)}
    P.set_policy(spark, t, "column_mask", "money.usd")
    assert _seen(spark, t, ents) == {"platform_owner": every, "x": hidden, "y": hidden, "stranger": hidden}
    P.set_policy(spark, t, "row_filter", "airline")
    assert _seen(spark, t, ents) == {"platform_owner": every, "x": hidden, "y": [(1, None)], "stranger": []}
    for c, g in CALLERS:
        one = P.read_secured(spark, t, ents, c, g)
        assert one.columns == spark.table(t).columns
        assert sorted((r.id, r["money.usd"]) for r in one.collect()) == _seen(spark, t, ents)[c]
    P.drop_policy(spark, t, "column_mask", "money.usd")
    assert _seen(spark, t, ents)["y"] == [(1, 5.0)]
    P.drop_policy(spark, t, "row_filter", "airline")
    assert P.policies(spark, t) == [] and _seen(spark, t, ents)["stranger"] == every


def test_inventory_and_export_follow_the_policies(spark, db, ents):
    assert P.inventory(spark, db, ents).count() == 0
    P.export_guard(spark, f"{db}.fleet")
    P.set_policy(spark, f"{db}.fleet", "row_filter", "airline")
    P.set_policy(spark, f"{db}.none", "column_mask", "money.usd")
    got = {tuple(r) for r in P.inventory(spark, db, ents).collect()}
    assert got == {("fleet", "row_filter", "airline", "airline_row_filter", 5, 3),
                   ("none", "column_mask", "money.usd", "financial_mask", 5, 2)}
    with pytest.raises(PermissionError):
        P.export_guard(spark, f"{db}.fleet")
    assert P.read_secured(spark, f"{db}.none", ents, "x", []).count() == 0
    P.drop_policy(spark, f"{db}.fleet", "row_filter", "airline")
    assert {r.table_name for r in P.inventory(spark, db, ents).collect()} == {"none"}


def test_closed_where_a_policy_cannot_be_applied(spark, db, ents):
    t = f"{db}.fleet"
    with pytest.raises(ValueError, match="no column"):
        P.set_policy(spark, t, "row_filter", "nothing")
    with pytest.raises(ValueError, match="unknown kind"):
        P.set_policy(spark, t, "column_filter", "airline")
    P.set_policy(spark, t, "row_filter", "airline")
    with pytest.raises(ValueError, match="already"):
        P.set_policy(spark, t, "row_filter", "id")
    spark.sql(f"ALTER TABLE {t} SET TBLPROPERTIES ('wingspan.column_mask.money.usd' = 'some_function')")
    with pytest.raises(PermissionError, match="some_function"):
        P.read_secured(spark, t, ents, "platform_owner", [])
    spark.sql(f"ALTER TABLE {t} UNSET TBLPROPERTIES ('wingspan.column_mask.money.usd')")
    spark.sql(f"ALTER TABLE {t} SET TBLPROPERTIES ('wingspan.column_mask.gone' = 'financial_mask')")
    with pytest.raises(PermissionError, match="gone"):
        P.read_secured(spark, t, ents, "platform_owner", [])
