"""Pruned search against full scoring, and the versioned index through crashes at every step."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wingspan.operators import search as S
from wingspan.operators.pruned_search import ImpactIndex
from wingspan.operators.versioned_index import VersionedIndex, sync_stream


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(300)], k=rng.randrange(1, 30)))) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(40)] + [(3000, "only here"), (3001, "")]
    chunks = spark.createDataFrame(rows, "chunk_key long, search_text string")
    queries = [(i, rows[i * 7][1]) for i in range(12)] + [(50, "only"), (51, "nothing known"), (52, "w0 w1 w2"), (53, "w0 w0")]
    return chunks, spark.createDataFrame(queries, "query_id int, query_text string"), ImpactIndex.build(chunks)


@pytest.mark.parametrize("measure", ["keyword", "vector"])
def test_pruned_top_k_equals_full_scoring(corpus, measure):
    chunks, queries, index = corpus
    full = S.SearchIndex.build(chunks)
    scores = full.bm25(queries) if measure == "keyword" else full.cosine(queries)
    want = S.top_k(scores, 5, order=[F.round("score", 9).desc(), F.col("chunk_key")])
    cols = ["query_id", "rank", "chunk_key"]
    got = index.top(queries, 5, measure)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    w = index.weights(queries, measure)
    pairs = index.candidates(w, index.thresholds(w, measure, 5), measure)
    assert pairs.count() < scores.count() / 2  # random words: the bounds are loose


@pytest.mark.parametrize("measure", ["keyword", "vector"])
def test_sums_of_many_postings_stay_with_their_chunks(corpus, monkeypatch, measure):
    from wingspan.operators import pruned_search as P
    _, queries, index = corpus
    w = index.weights(queries, measure)
    theta = index.thresholds(w, measure, 5)
    pairs = index.candidates(w, theta, measure)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "query_id" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    scanned = {tuple(r) for r in pairs.collect()}
    monkeypatch.setattr(P, "SCAN_QUERIES", 0)
    read = {tuple(r) for r in index.candidates(w, theta, measure).collect()}
    best = {(r[0], r[1]) for r in index.top(queries, 5, measure).select("query_id", "chunk_key").collect()}
    assert best <= scanned and best <= read and len(scanned) <= len(read)
    monkeypatch.setattr(P, "SCAN_CELLS", 40)
    monkeypatch.setattr(P, "SCAN_QUERIES", 100)
    assert {tuple(r) for r in index.candidates(w, theta, measure).collect()} == scanned


def state(index):
    rows = index.rows()
    return {} if rows is None else {r.chunk_id: r.search_text for r in rows.collect()}


class Crash(Exception):
    pass


def stop_after(n):
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == n:
            raise Crash(name)
    return step


def test_crash_at_every_step_keeps_the_old_version(spark, tmp_path):
    index = VersionedIndex(spark, str(tmp_path / "index"))
    schema = "chunk_id string, change string, search_text string, lang string"
    index.apply(spark.createDataFrame([("a", "inserted", "oil pump", "en"), ("b", "inserted", "oil filter", "de")], schema))
    first = state(index)
    change = spark.createDataFrame([("a", "deleted", None, None), ("b", "updated", "fuel filter", "de"),
                                    ("c", "inserted", "pump pump", "en")], schema)
    steps = 0
    while True:
        try:
            steps += 1
            index.apply(change, epoch=0, step=stop_after(steps))
            break
        except Crash as e:
            if str(e) == "committed":  # the version is in force, only its writer died
                break
            assert state(index) == first and index.manifest()["version"] == 1
    assert steps == 6
    want = {"b": "fuel filter", "c": "pump pump"}
    assert state(index) == want
    index.apply(change, epoch=0)  # replay
    assert index.manifest()["version"] == 2 and state(index) == want
    segments = index.manifest()["segments"]
    index.apply(spark.createDataFrame([("b", "updated", "fuel filter", "de")], schema))  # same content: no segment
    assert index.manifest()["segments"] == segments and state(index) == want
    with pytest.raises(Crash):
        index.merge(step=stop_after(1))
    assert state(index) == want
    index.merge()
    m = index.manifest()
    assert len(m["segments"]) == 1 and m["deletes"] == [] and state(index) == want and m["rows"] == 2
    assert index.vacuum() and state(index) == want


def test_search_reads_live_rows_only(spark, tmp_path):
    index = VersionedIndex(spark, str(tmp_path / "index"))
    assert index.search("oil") is None and index.rows() is None
    rng = random.Random(1)
    rows = [(f"k{i:03d}", "inserted", " ".join(rng.choices(["oil", "pump", "valve", "seal", "x"], k=rng.randrange(1, 9))),
             rng.choice(["en", "de"])) for i in range(120)]
    schema = "chunk_id string, change string, search_text string, lang string"
    index.apply(spark.createDataFrame(rows[:80], schema))
    index.apply(spark.createDataFrame(rows[80:] + [(r[0], "deleted", None, None) for r in rows[:10]]
                                      + [(rows[20][0], "updated", "oil oil oil", "en")], schema))
    live = {r[0]: (r[2], r[3]) for r in rows[10:]} | {rows[20][0]: ("oil oil oil", "en")}
    chunks = spark.createDataFrame([(k, *v) for k, v in live.items()], "chunk_id string, search_text string, lang string")
    q = spark.createDataFrame([(0, "oil seal")], "query_id int, query_text string")
    for filters, part in (({}, None), ({"lang": "de"}, "de")):
        scores = S.SearchIndex.build(chunks, "chunk_id").bm25(q)
        if part:
            scores = scores.join(chunks.filter(F.col("lang") == part), "chunk_id", "left_semi")
        want = S.top_k(scores, 6, order=[F.round("score", 9).desc(), F.col("chunk_id")]).orderBy("rank").collect()
        got = index.search("oil seal", 6, filters).collect()
        assert [(r.chunk_id, round(r.score, 9)) for r in got] == [(r.chunk_id, round(r.score, 9)) for r in want]


def test_stream_replay_after_crash(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    index = VersionedIndex(spark, str(tmp_path / "index"))
    schema = "chunk_id string, change string, search_text string, v int"
    spark.createDataFrame([("a", "inserted", "one", 1), ("a", "updated", "two", 2), ("b", "inserted", "x", 1)],
                          schema).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    with pytest.raises(Exception):
        sync_stream(stream, index, ck, order="v", step=stop_after(3))
    assert state(index) == {}
    sync_stream(spark.readStream.schema(schema).parquet(src), index, ck, order="v")
    assert state(index) == {"a": "two", "b": "x"} and index.manifest()["version"] == 1
    spark.createDataFrame([("b", "deleted", None, 2)], schema).write.mode("append").parquet(src)
    sync_stream(spark.readStream.schema(schema).parquet(src), index, ck, order="v")
    assert state(index) == {"a": "two"} and index.manifest()["version"] == 2


def test_the_query_set_goes_to_the_index_and_only_the_asked_measure_is_built(spark, monkeypatch):
    from wingspan.operators import pruned_search as P
    wrote = []
    monkeypatch.setattr(P, "materialize", lambda df, name, real=P.materialize: wrote.append(name) or real(df, name))
    rows = [(i, f"oil pump w{i % 9}") for i in range(60)] + [(3, "oil oil seal")]  # rows of one key are one chunk
    chunks = spark.createDataFrame(rows, "chunk_key long, search_text string")
    queries = spark.createDataFrame([(0, "oil seal"), (1, "pump w4")], "query_id int, query_text string")
    index = P.ImpactIndex.build(chunks)
    got = index.top(queries, 4)
    assert [r.chunk_key for r in got.filter("query_id = 0 and rank = 1").collect()] == [3]
    assert "impact-keyword" in wrote and not {"impact-vector", "impact-norms", "impact-tf"} & set(wrote)
    asked = P._asked(queries.select(F.lit("oil").alias("term")), "asked")
    plan = index.postings("keyword").join(asked, "term")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan  # the postings stay where they lie
    assert [r.dl for r in index.vectors.filter("chunk_key = 3").collect()] == [6]


def test_norms_do_not_depend_on_which_terms_are_broadcast(spark, monkeypatch):
    from wingspan.operators import pruned_search as P
    rows = [(i, f"oil pump w{i % 9} v{i}") for i in range(40)]
    chunks = spark.createDataFrame(rows, "chunk_key long, search_text string")

    def norms():
        index = P.ImpactIndex.build(chunks)
        return [sorted((r[0], round(r[-1], 9)) for r in t.collect()) for t in (
            index.norms(), index.postings("vector").groupBy("chunk_key").agg(F.sum("impact").alias("s")))]
    every = norms()
    monkeypatch.setattr(P, "FREQUENT_TERMS", 5)
    assert norms() == every and len(every[0]) == 40


def test_a_feed_is_worked_out_once_and_its_terms_are_counted_in_the_row(spark, tmp_path):
    import collections

    from wingspan.operators.versioned_index import VersionedIndex
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    texts = {"a": "Fan blade, fan case", "b": "", "c": "... --", "d": "blade " * 3000, "e": None}
    schema = "chunk_id string, chunk string, change string"
    feed = spark.createDataFrame([(k, t, "inserted") for k, t in texts.items()], schema).mapInArrow(seen, schema)
    index = VersionedIndex(spark, str(tmp_path / "index"), "chunk_id", "chunk")
    state = index.apply(feed, epoch=0)
    assert runs.value == len(texts)
    got = {(r.chunk_id, r.term): (r.tf, r.dl) for r in index._live(state, "postings").collect()}
    words = {k: re.findall(r"[a-z]+", (t or "").lower()) for k, t in texts.items()}
    assert got == {(k, w): (n, len(ws)) for k, ws in words.items() for w, n in collections.Counter(ws).items()}
    with pytest.raises(ValueError):
        index.apply(spark.createDataFrame([(None, "x", "deleted")], schema), epoch=1)
