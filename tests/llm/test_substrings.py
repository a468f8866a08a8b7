import hashlib
import random
import re

import numpy as np
import pytest

from wingspan.llm import induced_sorting as I
from wingspan.llm import passages as P
from wingspan.llm import suffix_array_dedup as D
from wingspan.llm import suffix_automaton as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = ["the", "of", "a", "in"] + ["word%d" % i for i in range(60)] + ["é", "ünï", "x" * 30]
    para = [[rnd.choice(vocab) for _ in range(rnd.choice([5, 14, 20, 80, 200]))] for _ in range(14)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(0, 5)):
            if rnd.random() < 0.5:
                p = rnd.choice(para)
                a = rnd.randrange(len(p))
                p = p[a:] if rnd.random() < 0.3 else list(p)
                if rnd.random() < 0.4:
                    p[rnd.randrange(len(p))] = "edit%d" % rnd.randrange(3)
                parts += p
            else:
                parts += [rnd.choice(vocab) for _ in range(rnd.randrange(30))]
        rows.append((i * 7 % 1000, rnd.choice([" ", "\n", "  "]).join(parts)))
    rows += [(2000, None), (2001, ""), (2002, "again " * 3000), (2003, "again " * 50), (2004, "a b c d " * 40),
             (2005, "the of a in " * 30), (None, "a b c d " * 40), (None, None), (2006, "a b c d " * 9),
             (7, "a b c d " * 20), (2006, "a b c d " * 9)]
    return rows


def slow_words(rows, window=13):
    words = [WORD.findall(t or "") for _, t in rows]
    order = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for o, ws in zip(order, words):
        for k in range(len(ws) - window + 1):
            w = tuple(ws[k:k + window])
            first[w] = min(first.get(w, o), o)
    out = []
    for o, ws in zip(order, words):
        gone = {k + j for k in range(len(ws) - window + 1) if first[tuple(ws[k:k + window])] < o
                for j in range(window)}
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [20000, 2])
def test_word_dedup_against_brute_force(spark, limit):
    rows = corpus(limit)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(5)
    got = A.dedup_words(df, automaton_contents=limit).collect()
    seen = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest())
                  for r in got)
    want = sorted((i is None, i or 0, *x) for (i, _), x in zip(rows, slow_words(rows)))
    assert seen == want
    assert sum(x[3] for x in want) > 1000
    assert A.dedup_words(df.limit(0)).count() == 0


def test_automaton_owners_against_brute_force():
    rnd = random.Random(2)
    seqs = [([rnd.choice("abc") for _ in range(rnd.randrange(0, 40))], rnd.randrange(100)) for _ in range(30)]
    auto = A.SuffixAutomaton()
    for s, o in seqs:
        auto.add(s, o)
    auto.finish()
    for s, _ in seqs + [([rnd.choice("abcd") for _ in range(60)], 0)]:
        for w in (1, 3, 5):
            want = [min((o for t, o in seqs if any(t[j:j + w] == s[i:i + w] for j in range(len(t) - w + 1))),
                        default=P.NO_ID) for i in range(len(s) - w + 1)]
            assert auto.owners(s, w) == want


def test_runs_cover_each_window_once():
    rnd = np.random.default_rng(1)
    for n, width in [(50, 7), (7, 7), (6, 7), (1000, 33)]:
        order = rnd.integers(0, 5 if n == 50 else 1 << 62, n).astype(np.uint64) << np.uint64(24)
        at, first, count = P.anchored_runs(order, width)
        want = [int(np.argmin(order[i:i + width])) + i for i in range(n - width + 1)]
        got = [a for a, c in zip(at.tolist(), count.tolist()) for _ in range(c)]
        assert got == want and (np.cumsum(count) - count == first).all()


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(4)
    for text in [b"", b"a", b"aaaaaaaaaa", b"banana", b"mississippi" * 7, bytes(rnd.choice(b"ab") for _ in range(3000)),
                 bytes(rnd.choice(b"abcdefgh") for _ in range(700)) * 4, bytes(range(1, 255)), b"abracadabra" * 300]:
        s = np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 1, 0)
        want = sorted(range(len(s)), key=lambda i: text[i:] if i < len(text) else b"")
        sa = I.suffix_array(s)
        assert sa.tolist() == want
        lcp = I.permuted_lcp(text + b"\x00", sa, np.array([0]), len(s) + 8)
        for x, y in zip(want, want[1:]):
            n = 0
            while max(x, y) + n < len(text) and text[x + n] == text[y + n]:
                n += 1
            assert lcp[y] == n


def slow_bytes(rows, window):
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in data:
        for i in range(len(b) - window + 1):
            seen[b[i:i + window]] = seen.get(b[i:i + window], 0) + 1
    out = []
    for b in data:
        cut = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                cut[i:i + window] = True
        runs = int(np.count_nonzero(np.diff(cut.astype(np.int8), prepend=0) == 1))
        kept = np.frombuffer(b, np.uint8)[~cut].tobytes()
        out.append((len(b), int(cut.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window,limit", [(400, 10000), (60, 10000), (60, 1)])
def test_byte_dedup_against_brute_force(spark, window, limit):
    rows = corpus(window)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(5)
    got = D.dedup_bytes(df, window=window, gram=32 if window == 400 else 16, array_contents=limit).collect()
    seen = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans,
                   hashlib.sha256(r.kept).hexdigest()) for r in got)
    want = sorted((i is None, i or 0, *x) for (i, _), x in zip(rows, slow_bytes(rows, window)))
    assert seen == want
    assert sum(x[3] for x in want) > 1000
    assert D.dedup_bytes(df.limit(0)).count() == 0


@pytest.mark.parametrize("module", [A, D])
def test_texts_cut_together_give_the_passages_of_each_alone(module):
    """Windows never cross from one text into the next, wherever the texts are joined."""
    words = [b"w%d" % (i * i % 97) for i in range(400)]
    texts = [b"", b" ".join(words[:60]), b"a b c", b" ".join(words[40:100]), b" ".join(words), b" ".join(words[:12])]
    cut = module.cutter(window=13, gram=3) if module is A else module.cutter(window=40, gram=8)

    def rows(at, batch):
        p = cut(batch)
        cols = () if p is None else (p.text + at, p.anchor, p.start, p.count, p.lo, p.hi, p.offset)
        return [(t, a, s, n, p.data[lo:hi], o) for t, a, s, n, lo, hi, o in zip(*(c.tolist() for c in cols))]
    alone = [r for i, t in enumerate(texts) for r in rows(i, [t])]
    assert rows(0, texts) == alone and len({t for t, *_ in alone}) >= 3
