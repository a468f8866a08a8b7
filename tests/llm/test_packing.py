import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wingspan.llm import drr_packing as D
from wingspan.llm.tokens import default_path, encoder


def test_word_encoder_equals_the_tokenizer():
    rnd = random.Random(1)
    w = ["it's", "don't'", "'sx", "É", "é́", "Å", "́x", "a b", "a b", "<|endoftext|>", "<|ENDOFTEXT|>", "12ab3",
         "x,", "(y)", "the.", "straße", "ΣΑΣ", "İ", "日本", "​", "à.", "x.́", "q'", "foo's,", "\x1f", "\x85", "\x1c"]
    texts = ["", " ", "\n a \t"] + ["".join(rnd.choice(w + [" ", "\n"]) for _ in range(12)) for _ in range(3000)]
    ref = Tokenizer.from_file(default_path()).encode_batch(texts, add_special_tokens=False)
    got = encoder().encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in ref]




def test_schedule_serves_every_token_once_and_on_target():
    rnd = random.Random(2)
    for tokens, shares in [([1000, 300, 77], None), ([5, 0, 9000, 1], [1, 1, 1, 1]), ([50], None), ([0], None),
                           ([rnd.randrange(1, 5000) for _ in range(12)], [rnd.random() for _ in range(12)])]:
        s = D.schedule(tokens, shares or [float(t) for t in tokens], 64)
        stream = {}
        for q, t in enumerate(tokens):
            at = 0
            while at < t:
                n = min(t - at, rnd.randrange(1, 200))
                lo, pos = s.place(q, at, n)
                size = np.diff(lo, append=n)
                assert lo[0] == 0 and (size > 0).all()
                for a, p, z in zip(lo, pos, size):
                    assert p // 64 == (p + z - 1) // 64
                    for i in range(z):
                        assert int(p + i) not in stream
                        stream[int(p + i)] = (q, at + int(a) + i)
                at += n
        assert sorted(stream) == list(range(sum(tokens)))
        for q in range(len(tokens)):  # queue order is kept
            mine = [i for _, (x, i) in sorted(stream.items()) if x == q]
            assert mine == list(range(len(mine)))
        if shares is None and sum(tokens):
            for w in range(sum(tokens) // 64):
                got = [stream[p][0] for p in range(64 * w, 64 * w + 64)]
                for q, t in enumerate(tokens):
                    assert abs(got.count(q) - 64 * t / sum(tokens)) <= len(tokens) + 1


def check(rows, pieces, length):
    t = Tokenizer.from_file(default_path())
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in rows}
    docs, seqs = {}, {}
    for p in pieces:
        want = ids[p.doc_id][p.start:p.start + p.length]
        assert p.length == len(want) > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert np.frombuffer(p.ids, "<u4").tolist() == want
        docs.setdefault(p.doc_id, []).append((p.start, p.length))
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(docs) == set(ids)
    for i, spans in docs.items():
        assert sum(n for _, n in spans) == len(ids[i])
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
    assert sorted(seqs) == list(range(len(seqs)))
    for k, spans in seqs.items():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at == length or k == len(seqs) - 1


def test_pack_against_the_tokenizer(spark):
    rnd = random.Random(3)
    words = "the of and tion's ing é ß 12 foo, bar.".split()
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 80, 700]))),
             rnd.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    rows += [(900, None, "a"), (901, "x " * 40000, None), (902, "", "zz")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, start int")
    for targets, queues in [(None, 256), ({"a": 0.2, "b": 0.5}, 256), (None, 2), (None, 1)]:
        got = D.pack(df.repartition(5), targets=targets, max_queues=queues, length=256).collect()
        check([r[:2] for r in rows], got, 256)
    pieces = D.pack(df, length=2048)
    seqs = D.sequences(pieces).withColumn("n", F.length("ids") / 4).collect()
    assert sum(r.n_tokens for r in seqs) == sum(r.length for r in pieces.collect())
    assert all(r.n == 2048 or (r.n == r.n_tokens and r.n_tokens.bit_count() == 1) for r in seqs)
    assert D.pack(df.limit(0)).count() == 0


def test_query_crc(spark):
    from wingspan.llm.queries import QUERIES
    rows = QUERIES["op1_drr_packing"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    t = Tokenizer.from_file(default_path())
    ids = {d.doc_id: np.array(t.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4") for d in docs}
    assert {r.doc_id for r in rows} == set(ids)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())


def stream_sources(docs, pieces, length):
    """Source of every token of the stream."""
    of, out = {r.doc_id: r.source for r in docs}, {}
    for p in pieces:
        for i in range(p.length):
            at = p.sequence_id * length + p.offset + i
            assert at not in out
            out[at] = of[p.doc_id]
    assert sorted(out) == list(range(len(out)))
    return [out[i] for i in range(len(out))]


def test_more_sources_than_queues_keep_their_shares(spark):
    rnd = random.Random(5)
    rows = [(i, "the of and " * rnd.randrange(20, 60), f"s{i % 30}" if i % 3 else "big") for i in range(900)]
    rows += [(1000 + i, "foo bar " * 30, None) for i in range(20)] + [(2000 + i, "the " * 50, "rare") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs, length = df.collect(), 256
    for queues in (256, 8, 3):
        got = D.pack(df.repartition(5), max_queues=queues, length=length).collect()
        check([r[:2] for r in rows], got, length)
        stream = stream_sources(docs, got, length)
        whole = len(stream)
        for q in set(stream):  # any start of the stream holds a source's share
            at = [i for i, x in enumerate(stream) if x == q]
            off = max(abs(n - i * len(at) / whole) for n, i in enumerate(at))
            assert off <= 4 + length * len(at) / whole, (queues, q, off)  # a round serves queue after queue
        assert len({p.source_queue for p in got}) == len(set(stream))
    got = D.pack(df, targets={"rare": 0.1}, max_queues=8, length=length).collect()
    stream = stream_sources(docs, got, length)
    n = stream.count("rare")
    assert abs(stream[:5 * n].count("rare") - 0.5 * n) <= 8  # a tenth, though the smallest source
