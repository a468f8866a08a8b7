import collections
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from wingspan.llm import ipf_mixing as X


def slow_rake(cells, goals, sweeps):
    f = [{v: 1.0 for v in g} for g in goals]
    for _ in range(sweeps):
        for a in range(3):
            s = collections.defaultdict(float)
            for c, t in cells.items():
                s[c[a]] += t * np.prod([f[b][c[b]] for b in range(3) if b != a])
            f[a] = {v: goals[a][v] / s[v] if s[v] > 0 else 1.0 for v in f[a]}
    return f


def test_probabilities_against_brute_force(spark):
    rnd = random.Random(1)
    words = ["alpha", "beta", "cedar", "elder", "golf", "metal", "river", "tango", "x", "é"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 40))),
             rnd.choice(["en", "en", "de", None]), rnd.choice(["big"] * 5 + ["s1", "s2", None]), i)
            for i in range(600)]
    rows += [(601, None, "en", "big", 0), (602, "", None, "empty", 0), (602, "", None, "empty", 0),
             (None, "alpha beta", "en", "big", 0), (603, "alpha " * 3000, "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens int")
    got = X.mixing_probabilities(docs, tolerance=0.0, sweeps=8).select("doc_id", "text", "_mix.*").collect()
    assert len(got) == len(rows)
    cells = collections.Counter()
    for r in got:
        assert r.tokens == len((r.text or "").split())
        cells[r.source, r.lang, r.topic] += r.tokens
    goals = []
    for a in range(3):
        t = collections.Counter()
        for c, n in cells.items():
            t[c[a]] += n
        raw = {v: float(n) ** X.TEMPER for v, n in t.items()}
        goals.append({v: x / sum(raw.values()) for v, x in raw.items()})
    f = slow_rake(cells, goals, 8)
    w = {c: f[0][c[0]] * f[1][c[1]] * f[2][c[2]] for c in cells}
    all_tokens = sum(cells.values())
    top = max(w[c] for c in cells if cells[c] and
              sum(n for x, n in cells.items() if w[x] >= w[c] * (1 - 1e-12)) > X.SATURATION * all_tokens)
    for r in got:
        p = min(1.0, w[r.source, r.lang, r.topic] / top)
        assert abs(r.probability - p) < 1e-9
        key = r.text if r.doc_id is None else str(r.doc_id)
        u = int(hashlib.md5((key or "").encode()).hexdigest()[:8], 16) / 2**32
        assert r.kept == (u < r.probability)
    expected = collections.Counter()
    for c, n in cells.items():
        expected[c[0]] += n * w[c]
    total = sum(expected.values())
    assert all(abs(expected[v] / total - goals[0][v]) < 1e-3 for v in goals[0])


def test_given_targets_and_edges(spark):
    rows = [(i, "alpha beta gamma", "en" if i % 4 else "de", "a" if i % 3 else "b", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _extra int")
    got = X.mixing_probabilities(docs, targets={"source": {"a": 0.5, "gone": 0.2}, "lang": {"de": 0.5, "en": 0.5}},
                                 sweeps=20, saturation=0.0).select("source", "lang", "_mix.probability").collect()
    s = collections.Counter()
    for r in got:
        s[r.source] += r.probability
        s[r.lang] += r.probability
    assert abs(s["a"] / (s["a"] + s["b"]) - 0.5) < 1e-6 and abs(s["de"] / (s["de"] + s["en"]) - 0.5) < 1e-6
    kept = X.sample_mixture(docs)
    assert kept.columns == docs.columns and 0 < kept.count() <= 300
    assert X.sample_mixture(docs.limit(0)).count() == 0
    assert X.sample_mixture(docs.withColumn("text", F.lit(None).cast("string"))).count() == 300


def test_rare_values_reach_their_targets(spark):
    rows = [(i, "alpha beta gamma", "en", "b" if i % 200 == 0 else "a") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for targets, share in [({"source": {"b": 0.5}}, 0.5), (None, 10**X.TEMPER / (10**X.TEMPER + 1990**X.TEMPER))]:
        got = X.mixing_probabilities(docs, targets=targets).select("source", "_mix.probability").collect()
        s = collections.Counter()
        for r in got:
            assert 0 < r.probability <= 1
            s[r.source] += r.probability
        assert abs(s["b"] / (s["a"] + s["b"]) - share) < 1e-6
    got = X.mixing_probabilities(docs, targets={"source": {"b": 0.5}}, saturation=0.01).select("_mix.probability")
    assert got.filter("probability = 1").count() == 2000  # asked for: the rarest cell does not set the scale
