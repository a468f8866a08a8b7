"""Dense text vectors: exact Gram matrix, projection against a plain decomposition, edges, saved models."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wingspan.operators import embedding as E

SCHEMA = "chunk_id string, search_text string, term int, slot int"  # names that the operator uses itself


def _words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def _brute(rows, width):
    tf = {k: collections.Counter(_words(t)) for k, t in rows if _words(t)}
    df = collections.Counter(w for c in tf.values() for w in c)
    out = {}
    for k, c in tf.items():
        x, sq = np.zeros(width), 0
        for w, n in c.items():
            h = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
            v = math.floor((1 + math.log(n)) * (math.log((1.0 + len(tf)) / (1.0 + df[w])) + 1.0) * E.UNIT + 0.5)
            x[h % width] += v if h // width % 2 == 0 else -v
            sq += v * v
        out[k] = np.floor(x * E.UNIT / math.sqrt(sq) + 0.5)
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    topics = [[f"{t}word{i}" for i in range(30)] for t in ("hydraulic", "engine", "cabin")]
    made = [(f"{t}|{i}", " ".join(r.choice(topics[t], 12))) for t in range(3) for i in range(60)]
    copies = [(f"c|{i}", made[0][1]) for i in range(90)]  # a third of all rows is one text
    return made + copies + [("long|0", " ".join(r.choice(topics[1], 20_000)))]


def _table(spark, rows, parts=5):
    return spark.createDataFrame([(k, t, 1, 2) for k, t in rows], SCHEMA).repartition(parts)


def test_gram_equals_brute_force_at_any_partitioning(spark, rows):
    x = np.stack(list(_brute(rows, 64).values()))
    for parts in (1, 7):
        _, made = E.TextEmbedding.fit(_table(spark, rows, parts), width=64, dims=8)
        got = {r.slot: np.array(r.g) for r in E.gram(made, 64).collect()}
        want = x.T @ x
        assert set(got) == set(np.flatnonzero(want.any(axis=1)))
        assert all((want[s] == g).all() for s, g in got.items())


def test_vectors_are_the_leading_space_of_the_sketches(spark, rows):
    made = _brute(rows, 64)
    keys = list(made)
    x = np.stack([made[k] for k in keys])
    model, sk = E.TextEmbedding.fit(_table(spark, rows), width=64, dims=8)
    got = {r.chunk_id: np.array(r.embedding) for r in model.project(sk, "chunk_id").collect()}
    assert set(got) == set(keys)
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    y = x @ vt[:8].T
    y /= np.linalg.norm(y, axis=1)[:, None]
    z = np.stack([got[k] for k in keys])
    assert np.abs(z @ z.T - y @ y.T).max() < 1e-4
    assert all((got[f"c|{i}"] == got["0|0"]).all() for i in range(90))
    assert 0 < model.spectrum.sum() <= 1.0 + 1e-9 and (np.diff(model.spectrum) <= 1e-12).all()


def test_same_topic_is_nearer_than_another_without_a_common_word(spark):
    rows = [("a", "pump valve"), ("b", "valve seal"), ("c", "seal gasket"), ("d", "wing flap"), ("e", "flap slat"),
            ("f", "slat spoiler")]
    model, sk = E.TextEmbedding.fit(_table(spark, rows), dims=2)
    v = {r.chunk_id: np.array(r.embedding) for r in model.project(sk, "chunk_id").collect()}
    assert v["a"] @ v["c"] > 0.9 and abs(v["a"] @ v["f"]) < 0.5  # a and c share no word


def test_nulls_empty_texts_and_unknown_terms(spark, rows):
    extra = [("n", None), ("e", ""), ("p", " .,; "), (None, "hydraulicword1"), ("0|0", rows[0][1])]
    model, sk = E.TextEmbedding.fit(_table(spark, rows[:40] + extra), width=64, dims=8)
    got = [r.chunk_id for r in model.project(sk, "chunk_id").collect()]
    assert sorted(got) == sorted(k for k, _ in rows[:40])
    asked = spark.createDataFrame([(1, "hydraulicword1"), (2, "unheard"), (3, None), (4, "")], "q int, t string")
    assert [r.q for r in model.vectors(asked, "q", "t").collect()] == [1]
    assert E.TextEmbedding.fit(_table(spark, [])) is None
    assert E.TextEmbedding.fit(_table(spark, [("a", None)])) is None


def test_saved_model_gives_the_same_vectors(spark, rows, tmp_path):
    t = _table(spark, rows)
    model, sk = E.TextEmbedding.fit(t, width=64, dims=8)
    model.save(str(tmp_path / "model"))
    again = E.TextEmbedding.load(spark, str(tmp_path / "model"))
    a = {r.chunk_id: r.embedding for r in model.project(sk, "chunk_id").collect()}
    b = {r.chunk_id: r.embedding for r in again.vectors(t, "chunk_id", "search_text").collect()}
    assert a == b


def test_postings_stay_with_their_text_and_rare_terms_are_found(spark, rows):
    texts = _table(spark, rows)
    terms, made = E.fitted_sketches(texts, "chunk_id", "search_text", 64)
    tf = E.postings(texts, "chunk_id", "search_text")
    plan = E.sketches(tf, terms, "chunk_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the texts by key, no posting
    want = {r.chunk_id: (r.slots, r.x) for r in made.collect()}
    for common in (0, 7):  # most terms are joined by a shuffle
        got = {r.chunk_id: (r.slots, r.x) for r in E.sketches(tf, terms, "chunk_id", common).collect()}
        assert got == want


def test_words_are_counted_once_and_only_rare_terms_are_shuffled(spark, rows, monkeypatch):
    wrote = []
    monkeypatch.setattr(E, "materialize", lambda df, name, real=E.materialize: wrote.append((name, df)) or real(df, name))
    terms, made = E.fitted_sketches(_table(spark, rows), "chunk_id", "search_text", 64)
    names = dict(wrote)
    assert list(names) == ["embedding-counts", "embedding-terms", "embedding-sketches"]
    assert "Exchange" not in names["embedding-sketches"]._jdf.queryExecution().executedPlan().toString()
    want = {r.chunk_id: (r.slots, r.x) for r in made.collect()}
    for common in (1, 7):
        _, again = E.fitted_sketches(_table(spark, rows), "chunk_id", "search_text", 64, common)
        assert {r.chunk_id: (r.slots, r.x) for r in again.collect()} == want
