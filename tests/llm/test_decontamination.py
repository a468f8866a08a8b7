import hashlib
import random
import re

import pytest

from wingspan.llm import decontamination as D

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ws(text):
    return _WORD.findall((text or "").translate(_UP))


def slow(text, items, size=10):
    """(n_words, hit positions from 1, sorted items) by comparing every window."""
    doc, hit, seen = ws(text), set(), set()
    for item, t in items:
        w = ws(t)
        n = min(size, len(w))
        for g in {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else ():
            for i in range(len(doc) - n + 1):
                if tuple(doc[i:i + n]) == g:
                    hit.update(range(i + 1, i + n + 1))
                    seen.add("" if item is None else str(item))
    return len(doc), hit, sorted(seen)


def covered(spans):
    return {p for s in spans for p in range(s["first"], s["last"] + 1)}


def corpus(seed, n_items=12, n_docs=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "École", "É", "x1", "Zeit", "a", "b", "ß"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 5, 7, 9, 10, 11, 14, 40])))) for i in range(n_items)]
    items += [(3, "another text of the item " * 4), (None, "Unnamed, unnamed! of_the x1"), (77, None), (78, "..."),
              (79, items[0][1])]
    docs = []
    for i in range(n_docs):
        parts = []
        for _ in range(rng.randrange(6)):
            t = rng.choice(items)[1] or ""
            w = t.split()
            cut = w[rng.randrange(3):len(w) - rng.randrange(3)]
            parts += [rng.choice([" ".join(cut), t.upper(), ", ".join(w)]), " ".join(rng.choices(vocab, k=rng.randrange(20)))]
        docs.append((i, rng.choice([" ", "\n", "--"]).join(parts)))
    return items, docs + [(500, None), (501, ""), (502, "?!"), (3, docs[3][1]), (None, docs[5][1])]


@pytest.mark.parametrize("seed,block", [(1, 1_000_000), (2, 7)])
def test_mark_against_brute_force(spark, seed, block):
    items, docs = corpus(seed)
    d = spark.createDataFrame([(*x, 1, "r") for x in docs], "doc_id long, text string, n int, row string").repartition(3)
    b = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, w int")
    got = D.mark(d, b, block_seeds=block).collect()
    made = sorted((repr(r.row.doc_id), r.n_words, sorted(covered(r.spans)), list(r["items"])) for r in got)
    want = sorted((repr(i), n, sorted(h), s) for i, t in docs for n, h, s in [slow(t, items)])
    assert made == want
    assert any(h for _, _, h, _ in want)
    for r in got:  # spans are maximal, in order and apart
        assert all(x["last"] + 1 < y["first"] for x, y in zip(r.spans, r.spans[1:]))


def test_removal(spark):
    b = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    rows = [(1, "Keep this. One two, THREE four five six seven eight nine ten eleven! And this.", 7),
            (2, "one two three four five six seven eight nine", 7), (3, None, 7), (4, "", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = {r.doc_id: r for r in D.remove_spans(d, b).collect()}
    assert out[1].text == "Keep this! And this." and out[1].spans == 7
    assert [out[i].text for i in (2, 3, 4)] == [rows[1][1], None, ""]
    assert D.remove_spans(d, b).columns == d.columns
    assert sorted(r.doc_id for r in D.remove_documents(d, b).collect()) == [2, 3, 4]


def test_empty_tables_and_long_text(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    assert D.mark(spark.createDataFrame([], docs), spark.createDataFrame([(1, "a b")], items)).count() == 0
    d = spark.createDataFrame([(1, "a b c")], docs)
    assert [(r.n_words, r.spans, r["items"]) for r in D.mark(d, spark.createDataFrame([], items)).collect()] == [(3, [], [])]
    passage = " ".join(f"p{i}" for i in range(30))
    long = " ".join(f"w{i}" for i in range(200_000)) + " " + passage + " " + " ".join(["z"] * 50_000)
    r = D.mark(spark.createDataFrame([(1, long)], docs), spark.createDataFrame([(9, passage)], items)).first()
    assert (r.n_words, [(s["first"], s["last"]) for s in r.spans], r["items"]) == (250_030, [(200_001, 200_030)], ["9"])


def test_query_digest(spark, tmp_path):
    from wingspan.llm.queries import QUERIES
    items, docs = corpus(5)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(repr, map(tuple, QUERIES["op13_decontamination"](spark, str(tmp_path)).collect())))
    want = sorted(repr((i, n, len(h), len(s), hashlib.sha256(",".join(s).encode()).hexdigest(), len(h) > 0))
                  for i, t in docs for n, h, s in [slow(t, items)])
    assert got == want
