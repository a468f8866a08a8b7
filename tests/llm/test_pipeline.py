import re

import numpy as np
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from wingspan.llm.tokens import default_path

SF = "/root/testdata/sf0.001"


def test_stages_chain_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [sorted(r.doc_id for r in docs.select("doc_id").collect())]
    for name, stage in C.STAGES[:-1]:
        path = C.stored(stage(spark, docs, SF), f"test-{name}")
        assert path.columns == columns and path.schema["n_chars"] == docs.schema["n_chars"]
        docs = path
        seen.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
        assert set(seen[-1]) <= set(seen[-2]) and len(set(seen[-1])) == len(seen[-1])
        if name == "quality":
            good = {r.doc_id for r in E.queries()["op3_quality_bayes"](spark, SF).filter("kept").collect()}
            assert set(seen[-1]) == good
        if name == "near_duplicates":
            near = {r.doc_id: r for r in E.queries()["op4_simhash_pigeonring"](spark, SF).collect()}
            fps = [near[i].fingerprint for i in seen[-1]]
            assert len(set(fps)) == len(fps)
        if name == "pii":
            assert seen[-1] == seen[-2]
            for r in docs.collect():
                assert len(r.text) == r.n_chars
                assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text)
    assert [len(x) for x in seen] == sorted((len(x) for x in seen), reverse=True)
    assert len(seen[1]) < len(seen[0]) and len(seen[2]) < len(seen[1]) and len(seen[4]) < len(seen[3])
    pieces = C.STAGES[-1][1](spark, docs, SF).collect()
    t = Tokenizer.from_file(default_path())
    want = {r.doc_id: t.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    got = {i: [] for i in want}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert got == want
    assert xxhash.xxh64_intdigest(b"", 42) > 0


def test_run_is_registered_and_repeatable(spark):
    a = E.queries()["pipeline"](spark, SF).drop("ids").collect()
    b = C.run(spark, SF).drop("ids").collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        if docs.columns[0] != "doc_id" or "text" not in docs.columns:
            break
