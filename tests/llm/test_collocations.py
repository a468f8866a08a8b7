import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wingspan.llm import fm_collocations as C

_UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_UP))]


def slow(docs, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for p in pieces(text):
            n[lang] += len(p)
            for m in range(1, 5):
                f.update((lang, *p[i:i + m]) for i in range(len(p) - m + 1))
    cands = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    dropped = set()
    for g, a in cands.items():
        for m in range(2, len(g) - 1):
            for i in range(1, len(g) - m + 1):
                inner = (g[0], *g[i:i + m])
                if 100 * a >= 80 * f[inner]:
                    dropped.add(inner)
    out = []
    for g, a in cands.items():
        if g in dropped:
            continue
        cuts = [(2_000_000 * a // (f[g[:k + 1]] + f[(g[0], *g[k + 1:])]), k, f[g[:k + 1]], f[(g[0], *g[k + 1:])])
                for k in range(1, len(g) - 1)]
        score, _, l, r = min(cuts)
        out.append((g[0], -score, -a, " ".join(g[1:]).encode(), l, r))
    ranked, seen = set(), Counter()
    for lang, s, a, p, l, r in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.add((lang, seen[lang], p.decode(), -a, l, r, n[lang], -s))
    return ranked


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = ["of", "The", "été", "x-1", "\x1cz", "b", "c"] + [f"r{i}" for i in range(40)]
    phrases = ["new york city hall", "New York", "machine learning model", "a b a b a b", "été of The été"]
    docs = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(phrases), " ".join(rng.choices(vocab, k=rng.randrange(6)))]) for _ in range(rng.randrange(12))]
        docs.append((rng.choice([" ", "  ", ". ", "\n", "\t"]).join(parts), rng.choice(["en", "fr", None, "und"])))
    return docs + [(None, "en"), ("", "fr"), (".,;", None), ("  ", "en"), docs[0], docs[0]]


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("size,least,top", [(2_000_000, 30, 2000), (200, 8, 40)])
def test_against_brute_force(spark, size, least, top):
    docs = corpus(size)
    df = spark.createDataFrame([(*d, i, 0) for i, d in enumerate(docs)], "text string, lang string, n long, w1 int")
    got = C.collocations(df.repartition(3), least=least, top=top, shard_words=size).select(COLS).collect()
    want = slow(docs, least, top)
    assert len(got) == len(want) and {tuple(r) for r in got} == want and want


def test_empty_and_long(spark):
    schema = "text string, lang string"
    assert C.collocations(spark.createDataFrame([], schema)).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("one two", "en")], schema)).count() == 0
    docs = [(" ".join(["alpha beta", "gamma"] * 50_000), "en"), ("alpha beta", "en")]
    got = C.collocations(spark.createDataFrame(docs, schema), shard_words=1000).select(COLS).collect()
    assert {tuple(r) for r in got} == slow(docs, 30)


def test_words_of_slices():
    texts = ["", "Ab c", "d.e", "é,F\t g", "h", " i "]
    words, text, piece = C.split_words(pa.array(texts).slice(1))
    assert words.to_pylist() == ["ab", "c", "d", "e", "é", "f", "g", "h", "i"]
    assert text.tolist() == [0, 0, 1, 1, 2, 2, 2, 3, 4]
    assert (np.diff(piece) != 0).tolist() == [False, True, True, True, True, False, True, True]


def test_intervals_stay_synchronised():
    rng = np.random.default_rng(0)
    seq = np.concatenate([[0], rng.integers(0, 6, 3000), [0]])
    bwt, rbwt = C.fm_index(seq, 5)
    count = Counter(zip(seq.tolist(), seq[1:].tolist()))
    a, b, n, fwd, rev = C.two_words(bwt, 5)
    assert {(x, y): z for x, y, z in zip(a.tolist(), b.tolist(), n.tolist())} == {
        k: v for k, v in count.items() if 0 not in k}
    order, back = C.context_order(seq, 5), C.context_order(seq[::-1], 5)
    for x, y, z, f, r in zip(a, b, n, fwd, rev):
        assert (seq[order[f:f + z]] == x).all() and (seq[order[f:f + z] + 1] == y).all()
        assert (seq[::-1][back[r:r + z]] == y).all() and (seq[::-1][back[r:r + z] + 1] == x).all()
    kept = np.sort(a * 6 + b)
    three, four = C.longer_phrases(bwt, rbwt, 5, kept)
    for m, got in ((3, three), (4, four)):
        grams = Counter(tuple(seq[i:i + m].tolist()) for i in range(len(seq) - m + 1))
        assert {tuple(int(z) for z in g[:-1]): int(g[-1]) for g in zip(*got)} == {
            k: v for k, v in grams.items() if 0 not in k}


def test_scores_beyond_64_bits(spark):
    big = 1 << 61
    row = spark.range(1).selectExpr(f"CAST({big}L AS DECIMAL(20,0)) * {C.SCORE_SCALE} DIV (CAST({big}L AS DECIMAL(20,0)) + {big}L) s")
    assert row.first().s == C.SCORE_SCALE // 2
