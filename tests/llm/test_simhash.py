import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from wingspan.llm import simhash_pigeonring as S

M = (1 << 64) - 1


def slow_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_the_definition():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = " ".join(rnd.choice("The quick BROWN fox Élan x ä".split(" ")) for _ in range(n))
        assert S.simhash(t.encode()) == slow_fp(t)
    assert S.simhash(b"\t\n ") == 0


@pytest.mark.parametrize("limit", [2048, 3])
def test_links_lose_no_component(spark, limit):
    rnd = random.Random(limit)
    seeds = [rnd.getrandbits(64) for _ in range(6)] + [0]
    fps = set(seeds)
    for s in seeds:
        x = s
        for _ in range(25):
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3])):
                x ^= 1 << b
            fps.add(x)
            x = rnd.choice([x, s])
    fps = sorted(fps)
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    got = S.links(df, bucket_limit=limit).collect()
    pairs = {(r.a & M, r.b & M) for r in got}
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    want = slow_components(fps)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert [fps[w] for w in want] == [find(f) for f in fps]


def test_near_duplicates_against_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["w%d" % i for i in range(300)]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 40, 300]))) for _ in range(15)]
    texts = []
    for b in base:
        texts += [b] * rnd.choice([1, 3])
        w = b.split()
        w[rnd.randrange(len(w))] = "edit"
        texts.append(" ".join(w))
    texts += [None, "", "  ", "x", "x", "long " * 20000]
    rows = [(i * 3 + 1, t, "c", "extra") for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in
           S.near_duplicates(df).collect()}
    order = sorted(rows)
    fps = [slow_fp(r[1]) for r in order]
    comp = slow_components(fps)
    assert got == {r[0]: (f"{f:016x}", order[c][0]) for r, f, c in zip(order, fps, comp)}
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({order[c][0] for c in comp})


def test_edges_empty_table_repeats_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert S.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(2, "a b c"), (2, "a b c"), (None, "a b c"), (1, "q r s t u v"), (None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.doc_id or 0, r.component_id) for r in S.near_duplicates(df).collect()
                 if r.component_id is not None)
    assert got == [(0, 2), (1, 1), (2, 2), (2, 2)]
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in S.keep_one(df).collect())
    assert kept == [(False, 1, "q r s t u v"), (False, 2, "a b c"), (True, 0, ""), (True, 0, "a b c")]


def test_components_of_a_long_path(spark):
    from wingspan.llm.components import connected_components
    df = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    df = df.unionByName(spark.createDataFrame([(500, 400), (400, 450), (7, 7), (900, 900)], "a long, b long"))
    got = {r.node: r.root for r in connected_components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 450: 400, 500: 400, 900: 900}
