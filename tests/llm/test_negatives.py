import numpy as np
import pytest
from pyspark.sql import functions as F

from wingspan.llm import rtree_negatives as R


def slow(rows, positives=5, negatives=10, low=30, high=90):
    ok = [(i, lab, [int(z) for z in np.floor(256 * np.array(v, float))]) for i, lab, v in rows
          if i is not None and lab is not None and v and all(z is not None and np.isfinite(z) for z in v)]
    dim = max((len(v) for *_, v in ok), default=0)
    one = {}
    for i, lab, v in ok:
        one[i] = max(one.get(i, (lab, v)), (lab, v))
    one = {i: (lab, v + [0] * (dim - len(v))) for i, (lab, v) in one.items()}
    out = set()
    for i, (lab, q) in one.items():
        if i % 100:
            continue
        s = sorted(((-sum(a * b for a, b in zip(q, v)), j, other) for j, (other, v) in one.items() if j != i))
        for ps, p, _ in [z for z in s if z[2] == lab][:positives]:
            fits = [z for z in s if z[2] != lab and low * -ps <= 100 * -z[0] <= high * -ps][:negatives]
            out |= {(i, p, r + 1, j, -ps, -ns) for r, (ns, j, _) in enumerate(fits)}
    return out


def data(kind):
    rng = np.random.default_rng(5)
    n = 900
    if kind == "clustered":
        x = rng.normal(size=(12, 8))[rng.integers(0, 12, n)] + rng.normal(size=(n, 8)) * 0.05
    elif kind == "uniform":
        x = rng.normal(size=(n, 8))
    elif kind == "ties":
        x = rng.integers(-1, 2, size=(n, 3)) / 16.0
    else:  # a third of all rows is one vector
        x = rng.normal(size=(n, 8))
        x[: n // 3] = x[0]
    lab = rng.integers(0, 4, n)
    rows = [(i, int(lab[i]), [float(np.float32(z)) for z in v]) for i, v in enumerate(x)]
    return rows + [(1000, None, [1.0]), (1100, 1, None), (1200, 1, []), (1300, 1, [None, 1.0]), (1400, 2, [float("nan")]),
                   (1500, 2, [float("inf")]), (1600, 2, [0.5]), (None, 1, [1.0]), (100, 1, rows[200][2]), rows[300]]


@pytest.mark.parametrize("kind", ["clustered", "uniform", "ties", "copies"])
def test_against_brute_force(spark, kind):
    rows = data(kind)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, label int, embedding array<float>, rank int, part string").repartition(3)
    params = {} if kind == "uniform" else {"tree_rows": 150, "anchor_rows": 4}
    got = [tuple(r) for r in R.hard_negatives(df, F.col("id") % 100 == 0, **params).collect()]
    want = slow(rows)
    assert len(got) == len(set(got)) and set(got) == want and want


def test_small_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    ask = F.col("id") % 100 == 0
    assert R.hard_negatives(spark.createDataFrame([], schema), ask).count() == 0
    assert R.hard_negatives(spark.createDataFrame([(5, 1, [1.0])], schema), ask).count() == 0
    assert R.hard_negatives(spark.createDataFrame([(0, 1, [1.0])], schema), ask).count() == 0
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 9.0]), (3, 2, [0.95, 0.0]), (4, 2, [0.3, 0.0])]
    got = R.hard_negatives(spark.createDataFrame(rows, schema), ask).collect()
    assert {tuple(r) for r in got} == slow(rows) and len(got) == 1


def test_queue_skips_boxes():
    rng = np.random.default_rng(2)
    x = np.floor(np.concatenate([rng.normal(size=(640, 4)) + 50 * c for c in (np.eye(4)[0], -np.eye(4)[0], np.eye(4)[1])]) * 16)
    x = x[R.str_order(x, [0, 1])]
    ids, labels = np.arange(len(x)), np.zeros(len(x), np.int64)
    q = x[-1:]
    s, f, read = R.search(q, np.array([0]), np.array([-1]), np.array([0]), np.array([R._LOWEST + 1]), np.array([R._LAST]),
                          True, 5, x, ids, labels)
    full = (q @ x.T).astype(np.int64)[0]
    assert s[0].tolist() == sorted(full.tolist(), reverse=True)[:5]
    assert read < len(x) // R.LEAF // 2


def test_large_components_stay_exact():
    x = np.array([[2.0 ** 40, 1.0], [2.0 ** 40, 2.0], [-1.0, 5.0]])
    s, f, _ = R.search(x[:1], np.array([0]), np.array([0]), np.array([0]), np.array([R._LOWEST + 1]), np.array([R._LAST]),
                       True, 2, np.array([[2.0 ** 20, 1.0], [2.0 ** 20, 2.0], [-1.0, 5.0]]), np.array([0, 1, 2]),
                       np.zeros(3, np.int64))
    assert s[0].tolist() == [2 ** 60 + 2, -2 ** 40 + 5]
