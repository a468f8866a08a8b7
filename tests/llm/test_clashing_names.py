"""Operators keep columns of the input whatever they are called, and give the result they give without them."""

import pytest
from pyspark.sql import functions as F

from wingspan.llm import ipf_mixing, pii_boosting, quality_bayes, simhash_pigeonring

SF = "/root/testdata/sf0.001"
NAMES = ["_n", "_N_", "fp", "low", "component_id", "_host", "_path", "_evidence", "_quality", "_mix", "_cell", "_p", "n",
         "tokens", "topic", "w", "row", "rid", "p", "host_posterior", "quality", "label"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    return docs, docs.select("*", *[F.col("doc_id").alias(c) for c in NAMES]), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("stage", ["simhash", "quality", "mixing", "pii"])
def test_clashing_columns_stay(tables, stage):
    docs, wide, labels = tables
    run = {"simhash": simhash_pigeonring.keep_one, "quality": lambda d: quality_bayes.keep_good(d, labels),
           "mixing": ipf_mixing.sample_mixture, "pii": pii_boosting.redact}[stage]
    got = run(wide)
    assert got.columns == wide.columns
    rows = got.collect()
    assert rows and all(r[c] == r.doc_id for r in rows for c in NAMES)
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in run(docs).collect())
