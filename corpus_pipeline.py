"""Corpus pipeline: quality, near duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes every stage's result to the shared folder as Parquet and rereads it
as the next stage's documents.  All stages but the last keep the columns of
``documents``, further ones included whatever their names.

Every stage takes null, empty and very long texts, null or repeated ids and
empty tables: a null or empty text has no words, spans or shingles; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm import drr_packing, ipf_mixing, pii_boosting, quality_bayes, simhash_pigeonring
from wingspan.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the hierarchical classifier rejects go.

    Null sources and languages are groups of their own; repeated rows are judged alike.
    """
    return quality_bayes.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each near-duplicate component stays, the one of the smallest id.

    Texts without words are one component.  Of repeated rows of an id one stays; rows without an id pass.
    """
    return simhash_pigeonring.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data are replaced by their kind; n_chars, where there is one, follows the new text.

    Null texts stay null.
    """
    out = pii_boosting.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents drawn by their raked probabilities.

    The draw hashes the id (the text where it is null), so repeated rows are drawn or left together.
    """
    return ipf_mixing.sample_mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of all documents in token sequences, each window on the corpus mixture.

    A document without a token is its closing id alone; a null source is a queue like any other.
    """
    return drr_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The tokenizer and the XXH64 fingerprints have no DuckDB equivalent; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the result of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
