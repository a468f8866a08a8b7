"""Toxicity: FTRL-proximal logistic regression over hashed n-grams.

Features are hashed words, word pairs and skip pairs (one word left out) of
the whole text, present or not.  FTRL-proximal keeps a rate per coordinate
and an L1 threshold, so most of the 2^18 weights are exactly 0; the rest
are broadcast to the scoring tasks (the bound is the hash space, 1 MB).

Training uses at most ``max_train_docs`` labelled rows, the ones with the
smallest hash of their id (a documented bound; all labelled rows where there
are fewer).  They are hashed in parallel, written to the shared folder, and
one task runs the sequential updates over that bounded table.  Scoring reads
every document and shuffles nothing.

Labels, language, source and id are no inputs of a score.  Null and empty
texts score the bias.  Without labels of both classes every score is the
share of toxic labels (0 without labels).  Repeated rows score alike; of
repeated labels of one id the largest counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wingspan.llm.common import stored, utf8

HASH_BITS = 18
MAX_TRAIN_DOCS = 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.0
THRESHOLD = 0.3
_PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def features(data: bytes, bits: int = HASH_BITS) -> np.ndarray:
    """Sorted distinct coordinates of one whole text."""
    h64 = xxhash.xxh3_64_intdigest
    words = data.lower().split()
    h = np.fromiter((h64(w.strip(_PUNCTUATION)) for w in words), np.uint64, len(words))
    pairs = (h[:-1] * _MIX[0]) ^ (h[1:] >> np.uint64(7))
    skips = (h[:-2] * _MIX[1]) ^ (h[2:] >> np.uint64(11))
    return np.unique(np.concatenate([h, pairs, skips]) >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class Weights:
    """Sparse weights as a dense vector of the bounded hash space, and the bias."""

    w: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.w[x].sum(dtype=np.float64) + self.bias, -35, 35))))


def train_ftrl(rows: list[tuple[np.ndarray, int]], bits: int = HASH_BITS, epochs: int = EPOCHS, alpha: float = ALPHA,
               beta: float = BETA, l1: float = L1, l2: float = L2) -> Weights:
    """Sequential FTRL-proximal updates, ``epochs`` times over the rows in a fixed shuffled order.

    Per coordinate z and n give w = -(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2), or 0 within l1;
    the bias has no penalty.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    rng = np.random.default_rng(7)

    def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x, y = rows[i]
            zx, nx = z[x], n[x]
            w, wb = weight(zx, nx), -zb * alpha / (beta + nb ** 0.5)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + wb, -35, 35))) - y
            z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / alpha * w
            n[x] = nx + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb ** 0.5) / alpha * wb
            nb += g * g
    return Weights(weight(z, n).astype(np.float32), float(-zb * alpha / (beta + nb ** 0.5)))


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_train_docs: int = MAX_TRAIN_DOCS, bits: int = HASH_BITS) -> Weights:
    """Weights learned from labelled rows where ``train_on`` (over the label table) holds."""
    named = (labels.filter(train_on & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(id_col).agg(F.max(label_col).alias("_y"))
             .orderBy(F.xxhash64(id_col), id_col).limit(max_train_docs))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [features(t, bits) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in xs], pa.binary())],
                                             ["y", "x"])

    # at most max_train_docs pairs of id and label: the broadcast has a fixed bound
    rows = docs.join(F.broadcast(named), id_col).select(F.col("_y").cast("int").alias("y"), utf8(text_col).alias("t"))
    table = stored(rows.mapInArrow(hashed, "y int, x binary"), "ftrl-rows")
    share = table.agg(F.avg((F.col("y") > 0).cast("double")), F.count("*")).first()
    if not share[1] or share[0] in (0.0, 1.0):
        p = min(max(share[0] or 0.0, 1e-15), 1 - 1e-15)
        return Weights(np.zeros(1 << bits, np.float32), float(np.log(p / (1 - p))))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(y, x) for b in batches for y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        seen.sort()  # the files come in any order
        got = train_ftrl([(np.frombuffer(x, np.int32), int(y > 0)) for y, x in seen], bits)
        at = np.flatnonzero(got.w).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()]), pa.array([got.w[at].tobytes()]),
                                          pa.array([got.bias])], ["at", "w", "bias"])

    r = table.coalesce(1).mapInArrow(learn, "at binary, w binary, bias double").first()
    w = np.zeros(1 << bits, np.float32)
    w[np.frombuffer(r.at, np.int32)] = np.frombuffer(r.w, np.float32)
    return Weights(w, r.bias)


def score_documents(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, bits: int = HASH_BITS) -> DataFrame:
    """(id_col, score, predicted) of every row; ``predicted`` is 1 at ``threshold`` or above."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            s = np.array([model.score(features(t, bits)) for t in b.column(1).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col), utf8(text_col).alias("_t")).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
