import math
import random

import numpy as np
from pyspark.sql import functions as F

from wingspan.llm import toxicity_ftrl as T


def slow_ftrl(rows, bits):
    z, n, zb, nb = {}, {}, 0.0, 0.0

    def w(i):
        if abs(z.get(i, 0.0)) <= T.L1:
            return 0.0
        return (math.copysign(T.L1, z[i]) - z[i]) / ((T.BETA + math.sqrt(n[i])) / T.ALPHA + T.L2)
    rng = np.random.default_rng(7)
    for _ in range(T.EPOCHS):
        for k in rng.permutation(len(rows)):
            x, y = rows[k]
            ws = {i: w(i) for i in x.tolist()}
            wb = -zb * T.ALPHA / (T.BETA + math.sqrt(nb))
            g = 1 / (1 + math.exp(-(sum(ws.values()) + wb))) - y
            for i, wi in ws.items():
                ni = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(ni + g * g) - math.sqrt(ni)) / T.ALPHA * wi
                n[i] = ni + g * g
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / T.ALPHA * wb
            nb += g * g
    return {i: w(i) for i in z if w(i)}, -zb * T.ALPHA / (T.BETA + math.sqrt(nb))


def corpus(n):
    rnd = random.Random(1)
    rows = []
    for i in range(n):
        words = [rnd.choice("the of and tion er nd st ou".split()) for _ in range(30)]
        toxic = rnd.random() < 0.2
        if toxic:
            words[rnd.randrange(30)] = rnd.choice(["Rotten!", "vile"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_updates_against_the_plain_algorithm():
    rows = [(T.features(t.encode(), 10), y) for _, t, y in corpus(300)]
    got = T.train_ftrl(rows, 10)
    want, bias = slow_ftrl(rows, 10)
    assert abs(got.bias - bias) < 1e-9
    assert set(np.flatnonzero(got.w)) == set(want) and len(want) < 200
    assert all(abs(got.w[i] - v) < 1e-5 for i, v in want.items())


def test_held_out_accuracy_and_edges(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([(i, t, 0.1) for i, t, _ in rows] + [(-1, None, 0.0), (-2, "", 0.0),
                                                                     (-3, "vile " * 40000, 0.0)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (None, 1)], "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 2
    weights = T.fit(docs, labels, ~held)
    got = {r.doc_id: r for r in T.score_documents(docs, weights).collect()}
    assert len(got) == 1503 and 0 < np.count_nonzero(weights.w) < 2000
    wrong = [i for i, _, y in rows if i % 4 == 2 and got[i].predicted != y]
    assert len(wrong) <= 5
    assert got[-1].score == got[-2].score == weights.score(np.array([], np.int32))
    assert got[-3].predicted == 1
    flat = T.fit(docs, labels.limit(0), ~held)
    assert all(r.predicted == 0 for r in T.score_documents(docs, flat).collect())
    assert T.score_documents(docs.limit(0), flat).count() == 0
