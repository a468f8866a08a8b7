import hashlib
import random
import re

from pyspark.sql import functions as F

from wingspan.llm import pii_boosting as P

PAT = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def ok(kind, m):
    d = [int(c) for c in re.sub("[^0-9]", "", m)]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        s = sum(x if i % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(d[::-1]))
        return 14 <= len(d) <= 19 and s % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def slow_base(t):
    out = [(m.start(), k, m.end()) for k, kind in enumerate(P.KINDS)
           for m in re.finditer(PAT[kind], t or "") if ok(kind, m.group())]
    return ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


TEXTS = [
    None, "", "no data é here 4.0 and 2024", "mail a.b+c@x-y.co.uk, then é jo@a.b_c@d.e q@w", "a@b@c.d e@.f g@h..i",
    "ip 1.2.3.4.5.6.7.8 and 300.1.1.1 or 010.255.0.0 x1.2.3.4", "card 4111 1111 1111 1111 or 4111-1111-1111-1112 x",
    "tel +1 (974) 555-3436 and +49 30 1234 5678 90 +1+2 +12345", "\u0001 odd \u0002 marks a@b.cd \u0001",
    "a@b.cd" * 40, "9" * 30000, "1 " * 9000, "x" * 60000 + "@a.bc", "a." * 20000 + "@b.c", "+1" * 50,
    " ".join(f"u{i}@host{i}.example.com 10.0.{i % 256}.1" for i in range(700)),
]


def test_base_spans_equal_the_patterns(spark):
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choice("0123456789+ -().@ab.é\n") for _ in range(rnd.randrange(1, 120)))
                     for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.b for r in df.select("doc_id", P.listing(P.base_spans(
        F.coalesce("text", F.lit("")))).alias("b")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == slow_base(t), (i, (t or "")[:80])


def test_model_adds_look_alikes_and_redacts(spark):
    rnd = random.Random(4)

    def num():
        return f"({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"
    rows = [(i, f"please call +1 {num()} soon" if i % 3 else f"order {rnd.randrange(10**8, 10**9)} shipped", i)
            for i in range(900)]
    rows += [(1000 + i, f"please call 1 {num()} soon", 0) for i in range(5)] + [(2000, None, 1), (2001, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _spans int")
    got = {r.doc_id: r for r in P.find_pii(df).select("doc_id", P.listing(F.col("_base")).alias("b"),
                                                      P.listing(F.col("_spans")).alias("s")).collect()}
    assert len(got) == len(rows)
    assert all(got[i].b == "" and got[i].s == "phone:12:28" for i in range(1000, 1005))
    assert all(got[i].s == got[i].b == "" for i in (0, 3, 2000, 2001))
    out = P.redact(df.drop("_spans"))
    assert out.columns == ["doc_id", "text"]
    red = {r.doc_id: r.text for r in out.collect()}
    assert red[1] == "please call <phone> soon" and red[1001] == "please call <phone> soon"
    assert red[2000] is None and red[2001] == "" and red[0] == rows[0][1]


def test_empty_table_and_overlaps(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.find_pii(empty).count() == 0 and P.redact(empty).count() == 0
    t = "é +14111111111111111 z and a@1.2.3.4 end"
    df = spark.createDataFrame([(1, t), (1, t)], "doc_id long, text string")
    r = P.find_pii(df).select(P.listing(F.col("_spans")).alias("s"), F.sha2(P.listing(F.col("_base")), 256).alias("h"))
    want = slow_base(t)
    assert [tuple(x) for x in r.collect()] == [(want, hashlib.sha256(want.encode()).hexdigest())] * 2
    assert [x.text for x in P.redact(df).collect()] == ["é +14111111111111111 z and <email> end"] * 2
