import numpy as np
import pytest
from pyspark.sql import functions as F

from wingspan.llm import voronoi_knn as V


def slow(rows, top=20):
    ok = [(i, np.floor(64 * np.array(v, float)).astype(object)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in ok), default=0)
    ok = list({i: v for i, v in sorted(ok, key=lambda x: (x[0], list(x[1])))}.items())
    ok = [(i, [int(x) for x in v] + [0] * (dim - len(v))) for i, v in ok]
    out = set()
    for i, q in ok:
        if i % 20:
            continue
        best = {}
        for j, s in ok:
            if j != i:
                best[j] = max(best.get(j, -10**30), sum(a * b for a, b in zip(q, s)))
        for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:top]):
            out.add((i, r + 1, j, s))
    return out


@pytest.mark.parametrize("kind", ["clustered", "uniform", "ties"])
def test_top_k_against_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "clustered":
        x = rng.normal(size=(12, 8))[rng.integers(0, 12, 500)] + rng.normal(size=(500, 8)) * 0.02
    elif kind == "uniform":
        x = rng.normal(size=(500, 8))
    else:
        x = rng.integers(-1, 2, size=(500, 3)) / 64.0
    rows = [(i, [float(np.float32(z)) for z in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1020, []), (1040, [1.0, None]), (1060, [float("nan")] * 3), (1080, [float("inf")]),
             (1100, [0.5]), (20, rows[20][1]), (None, [1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    for params in ({}, {"pivots": 5, "group": 4, "block": 16, "chunk": 60}):
        got = V.top_inner_products(df, F.col("vec_id") % 20 == 0, **params).collect()
        assert len(got) == len(set(got))
        assert {tuple(r) for r in got} == slow(rows)


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    ask = F.col("vec_id") % 20 == 0
    assert V.top_inner_products(spark.createDataFrame([], schema), ask).count() == 0
    assert V.top_inner_products(spark.createDataFrame([(3, [1.0])], schema), ask).count() == 0
    one = V.top_inner_products(spark.createDataFrame([(0, [1.0]), (3, [0.5])], schema), ask).collect()
    assert [tuple(r) for r in one] == [(0, 1, 3, 64 * 32)]


def test_bounds_prune_clustered_data():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 8)) * 100
    hist = {(j, 0): 50 for j in range(6)}
    need = V.need_table(hist, {0: (1.0, 300.0)}, centre, 1.0, 20)
    assert (need[0] > 1.0).any() and need[0, 0] <= 1.0
