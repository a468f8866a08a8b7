"""The isolation forest's scoring: path lengths of whole arrays of rows, every row scored once."""

import math

import numpy as np
from pyspark.sql import functions as F

from wingspan.operators import models as M


def _one_by_one(tree, row):
    feat, thr, left, right, size = tree
    node = depth = 0
    while feat[node] >= 0:
        node = left[node] if row[feat[node]] < thr[node] else right[node]
        depth += 1
    return depth + M._c(size[node])


def test_path_lengths_equal_a_walk_of_every_row():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 3))
    x[3, 1], x[4, 0] = math.nan, math.inf
    for n in (1, 2, 90):
        tree = M._build_tree(rng.normal(size=(n, 3)), rng, 7)
        assert M._path_length(M._walkable(tree), x).tolist() == [_one_by_one(tree, r) for r in x]


def test_rows_are_scored_once(spark):
    rows = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("a"))
    scored = M.isolation_forest(rows, ["a"], ["id"], trees=5, per_tree=32)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.count() == 400
