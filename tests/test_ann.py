"""Approximate search: recall against brute force, copies, bad vectors, empty tables, other keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wingspan.operators import ann


def _table(spark, rows, key="long"):
    return spark.createDataFrame(rows, f"vec_id {key}, embedding array<float>, key int")


def _brute(rows, asked, k):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], "f4").astype("f8")
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for a in asked:
        s = x @ x[ids.index(a)]
        out[a] = sorted(((-round(v, 9), i) for i, v in zip(ids, s) if i != a))[:k]
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(7)
    made = [(i, [float(v) for v in r.normal(size=18)], 0) for i in range(900)]
    return made + [(i, made[3][1], 0) for i in range(900, 1300)]  # one vector holds a third of all rows


def test_recall_and_scores(spark, rows):
    t = _table(spark, rows).repartition(5)
    index = ann.AnnIndex.build(t, k=10)
    units = ann.unit_vectors(t, "vec_id", "embedding")
    asked = units.filter("key % 20 = 0").withColumnRenamed("key", "query")
    got = {}
    for r in index.search(asked, 10).collect():
        got.setdefault(r.query, []).append((-round(r.score, 9), r.key))
    want = _brute(rows, [i for i in range(0, 1300, 20)], 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hit = sum(sum(s <= want[q][-1][0] + 1e-6 for s, _ in found) for q, found in got.items())
    assert hit / (10 * len(want)) >= 0.9
    assert index.blocks.agg(F.sum(F.size("keys"))).first()[0] == 1300


def test_exact_equals_brute_force(spark, rows):
    units = ann.unit_vectors(_table(spark, rows).repartition(3), "vec_id", "embedding")
    asked = units.filter("key in (0, 3, 20, 901)").withColumnRenamed("key", "query")
    got = {}
    for r in ann.exact_top(units, asked, 10).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append(r.key)
    assert got == {q: [i for _, i in v] for q, v in _brute(rows, [0, 3, 20, 901], 10).items()}


def test_vectors_that_take_no_part(spark):
    good = [(i, [1.0, float(i), 2.0], 0) for i in range(6)]
    bad = [(10, None, 0), (11, [], 0), (12, [0.0, 0.0, 0.0], 0), (13, [1.0, None, 2.0], 0),
           (14, [1.0, float("nan"), 0.0], 0), (15, [float("inf"), 1.0, 0.0], 0), (16, [1.0, 2.0], 0),
           (None, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 2.0], 0)]
    t = _table(spark, good + bad)
    index = ann.AnnIndex.build(t, k=3)
    units = ann.unit_vectors(t, "vec_id", "embedding").withColumnRenamed("key", "query")
    got = index.search(units, 3).collect()
    assert {r.query for r in got} == set(range(6)) and {r["key"] for r in got} <= set(range(6))
    assert len(got) == 18 and index.search(units.filter("false"), 3).count() == 0


def test_empty_table_and_text_keys(spark):
    assert ann.AnnIndex.build(_table(spark, [])) is None
    t = _table(spark, [(c, [float(i), 1.0], 0) for i, c in enumerate("abcd")], "string")
    index = ann.AnnIndex.build(t, k=2)
    units = ann.unit_vectors(t, "vec_id", "embedding").withColumnRenamed("key", "query")
    best = {r.query: r["key"] for r in index.search(units, 2).filter("rank = 1").collect()}
    assert best == {"a": "b", "b": "c", "c": "d", "d": "c"}


def test_few_calibration_queries_may_lose_few_neighbours(spark):
    r = np.random.default_rng(11)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(r.normal(size=(900, 8)))]
    asked = [(-i - 1, [float(v) for v in x / np.linalg.norm(x)]) for i, x in enumerate(r.normal(size=(10, 8)))]
    asked = spark.createDataFrame(asked, "query long, unit array<double>")
    index = ann.AnnIndex.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=10, target=0.5,
                               asked=asked)
    got = ann.recall(index.search(asked, 10), ann.exact_top(index.units, asked, 10)).first()
    assert (got.n_neighbours, got.n_queries) == (100, 10) and got.recall >= 0.9
