import collections
import math
import random
import re

from wingspan.llm import host_rules as R
from wingspan.llm import quality_bayes as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(t):
    t = t or ""
    words = WORD.findall(t)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    c = collections.Counter(grams)
    cover = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(x in "#*$%&|<>" for x in t), dup, len(cover)


def corpus(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rnd.choice("ab cd é füß ## x|y <z> $%".split()) for _ in range(rnd.choice([0, 3, 12, 60]))]
        t = "".join(w + rnd.choice([" ", "  ", "\n", "\t", "\x0b", "\n\n"]) for w in words)
        rows.append((i, t, rnd.choice(["h1", "h1", "h1", "h2", None])))
    rows += [(n, None, "bad"), (n + 1, "", None), (n + 2, "word " * 50000, "bad"), (n + 3, "q", "bad")]
    rows += [(n + 10 + i, "too short", "bad") for i in range(60)]
    return rows


def test_rule_counts_and_verdicts_against_brute_force(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, kept int")
    got = {r.doc_id: r for r in R.apply_rules(df).collect()}
    hosts = collections.defaultdict(lambda: [0, 0])
    want = {}
    for i, t, h in rows:
        c = slow_counts(t)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want[i] = (c, failed, h)
        hosts[h][0] += 1
        hosts[h][1] += failed
    n, f = (sum(x[k] for x in hosts.values()) for k in (0, 1))
    p = f / n
    spread = sum(x[1] ** 2 / x[0] for x in hosts.values()) / n - p * p - p * (1 - p) * len(hosts) / n
    strength = min(max(p * (1 - p) / max(spread, 1e-12) - 1, 1.0), 1e6)
    passed = {h: (x[1] + p * strength) / (x[0] + strength) < R.MAX_HOST_RATE for h, x in hosts.items()}
    assert set(passed.values()) == {True, False}
    for i, (c, failed, h) in want.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c, i
        assert r.base_failed == failed and r.kept == (not failed and passed[h])
    assert R.apply_rules(df.limit(0)).count() == 0


def slow_features(t):
    t = t or ""
    words = WORD.findall(t)
    n = len(words)
    ws = re.split(r"\s+", t.strip())
    pairs = list(re.finditer(r"(?<!\S)(\S+)(?=\s\1(?!\S))", t))
    per = lambda x: x / n if n else 0.0
    v = [n, per(len(pairs)), per(len(re.findall(r"[#*$%&<>]+", t))),
         per(len(re.findall(r"(?<!\S)\|(?!\S)", t))), per(len(re.findall(r"!!+", t))),
         sum(c.isupper() for c in t) / max(len(t), 1)]
    assert ws is not None
    return [sum(x > e for e in edges) for x, edges in zip(v, Q.BINS.values())]


def test_quality_posteriors_against_brute_force(spark):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(500):
        host = rnd.choice(["a", "b", "b", None])
        good = rnd.random() < (0.3 if host == "a" else 0.9)
        words = [rnd.choice("the of and to it reh".split()) for _ in range(rnd.randrange(8, 60))]
        t = " ".join(words) if good else rnd.choice([" | ", "%%% ", "!! "]).join(words).upper()
        rows.append((i, t, rnd.choice(["en", "de", None]), host, 0.5))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    rows += [(900, None, "en", "a", 0.0), (901, "", None, None, 0.0), (901, "", None, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    labs = spark.createDataFrame(labels + [(3, None, 0)], "doc_id long, quality int, toxic int")
    got = collections.defaultdict(list)
    for r in Q.score_documents(docs, labs).select("doc_id", "_quality.*").collect():
        got[r.doc_id].append(r)
    lab = {i: q for i, q, _ in labels}
    feats = {r[0]: slow_features(r[1]) for r in rows}
    w = {}
    for f, edges in enumerate(Q.BINS.values()):
        for b in range(len(edges) + 1):
            s = []
            for y in (1, 0):
                n = sum(1 for i in lab if lab[i] == y)
                s.append((sum(1 for i in lab if lab[i] == y and feats[i][f] == b) + 1) / (n + len(edges) + 1))
            w[f, b] = math.log(s[0]) - math.log(s[1])
    ev = {i: sum(w[f, b] for f, b in enumerate(fb)) for i, fb in feats.items()}
    g = collections.defaultdict(lambda: [0, 0.0])
    for r in rows:
        g[r[3], r[2]][0] += 1
        g[r[3], r[2]][1] += 1 / (1 + math.exp(-ev[r[0]]))

    def strength(groups):
        n, s = sum(x[0] for x in groups), sum(x[1] for x in groups)
        m = s / n
        b = max(sum(x[1] ** 2 / x[0] for x in groups) / n - m * m - m * (1 - m) * len(groups) / n, 0)
        return min(max(m * (1 - m) / max(b, 1e-12) - 1, 1.0), 1e6), m
    hosts = collections.defaultdict(lambda: [0, 0.0])
    for (h, _), x in g.items():
        hosts[h][0] += x[0]
        hosts[h][1] += x[1]
    k1, m = strength(list(hosts.values()))
    k2, _ = strength(list(g.values()))
    for r in rows:
        hp = (hosts[r[3]][1] + k1 * m) / (hosts[r[3]][0] + k1)
        pp = (g[r[3], r[2]][1] + k2 * hp) / (g[r[3], r[2]][0] + k2)
        score = 1 / (1 + math.exp(-(ev[r[0]] + math.log(pp / (1 - pp)))))
        x = got[r[0]][0]
        assert abs(x.host_posterior - hp) < 1e-9 and abs(x.path_posterior - pp) < 1e-9
        assert abs(x.score - score) < 1e-9 and x.kept == (score >= 0.5)
    assert len(got[901]) == 2
    kept = Q.keep_good(docs, labs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    assert Q.score_documents(docs, labs.limit(0)).filter("_quality.kept").count() == len(rows)
    assert Q.score_documents(docs.limit(0), labs).count() == 0
