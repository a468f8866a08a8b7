"""Dense vectors of texts, fitted on the texts themselves (TX7): latent semantic analysis of hashed terms.

* **terms**: every term has an idf and, from its md5, a slot of ``WIDTH`` and a
  sign.  A text's sketch is the signed sum of its term weights
  ``(1 + ln tf) idf`` per slot over the length of the weight vector; inner
  products of sketches estimate the TF-IDF cosine, and no vocabulary is cut.
* **fit**: the Gram matrix of the sketches of every text.  Tasks multiply dense
  blocks and hand on one row per slot; the sums meet in one small shuffle of
  slots.  Its leading eigenvectors (``WIDTH`` x ``WIDTH``, at any number of
  texts, solved on the driver) are the projection.
* **vectors**: sketch times projection at length 1.

The texts are dealt by key once and their words counted and sketched in the row:
the ``COMMON`` terms of the most texts are broadcast to them, and only postings of
the other terms are sent to their document frequency and back.

Weights and sketches are whole numbers (``UNIT`` to one), so the Gram matrix is
exact: neither the partitions nor their order change it, and equal texts have
equal vectors.  Each eigenvector's largest component is positive.

Null and empty texts, and texts without a known term, have no vector.  Of rows
that repeat a key the texts count as one.  An empty table fits nothing (None).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.operators.search import count_terms, document_frequency, flat_terms, packed_terms, rare_terms, term_index
from wingspan.session import materialize

WIDTH = 512
DIMS = 64
UNIT = 1024
BLOCK_ROWS = 4_096  # rows of a dense block: products of whole numbers stay exact in doubles
PLACES = 6
COMMON = 1 << 18  # terms that are broadcast; postings of the others are joined by a shuffle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of the package


def postings(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf), dealt by key: what is grouped by the key from here on needs no shuffle."""
    return term_index(texts.filter(F.col(key).isNotNull()).select(key, text).repartition(key), key, text)


def term_slots(tf: DataFrame, key: str, width: int = WIDTH, n: int | None = None) -> DataFrame:
    """(term, slot, sign, idf) of all terms of the postings (key, term, tf) of ``n`` texts (default: counted here)."""
    if n is None:
        n = tf.agg(F.count_distinct(key)).first()[0]
    return _slots(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), n, width)


def _slots(df: DataFrame, n: int, width: int) -> DataFrame:
    """(term, slot, sign, idf) of (term, df)."""
    h = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long")
    return df.select(
        "term", (h % width).cast("int").alias("slot"),
        F.when(F.floor(h / width) % 2 == 0, 1).otherwise(-1).alias("sign"),
        (F.log((1.0 + F.lit(n)) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def _with_terms(tf: DataFrame, terms: DataFrame, key: str, common: int) -> DataFrame:
    """The postings of known terms with slot, sign and idf; ``tf`` stays dealt as it is."""
    first = terms.orderBy("idf", "term").limit(common)  # the smallest idf is the largest document frequency
    near = F.broadcast(first.select("term", F.struct("slot", "sign", "idf").alias("_t")))
    if terms.count() <= common:
        return tf.join(near, "term").select(key, "term", "tf", "_t.*")
    known = F.broadcast(first.select("term"))
    far = (tf.select(key, "term").join(known, "term", "left_anti")
           .join(terms.join(known, "term", "left_anti").hint("shuffle_hash"), "term")
           .groupBy(key).agg(F.map_from_entries(F.collect_list(
               F.struct("term", F.struct("slot", "sign", "idf")))).alias("_far")))
    both = tf.join(near, "term", "left").join(far.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left")
    return (both.select(key, "term", "tf", F.coalesce("_t", F.try_element_at("_far", F.col("term"))).alias("_t"))
            .filter(F.col("_t").isNotNull()).select(key, "term", "tf", "_t.*"))


def sketches(tf: DataFrame, terms: DataFrame, key: str, common: int = COMMON) -> DataFrame:
    """(key, slots, x): the whole-numbered sketch of every text with a known term, by ascending slot."""
    w = F.floor((1.0 + F.log(F.col("tf"))) * F.col("idf") * UNIT + 0.5).cast("long")
    each = _with_terms(tf, terms, key, common).select(key, "slot", (w * F.col("sign")).alias("v"), (w * w).alias("sq"))
    rows = (each.groupBy(key, "slot").agg(F.sum("v").alias("v"), F.sum("sq").alias("sq"))
            .groupBy(key).agg(F.sum("sq").alias("sq"), F.collect_list(F.struct("slot", "v")).alias("s")))
    x = F.transform(F.array_sort("s"), lambda s: F.struct(
        s.slot.alias("slot"), F.floor(s.v * UNIT / F.sqrt("sq") + 0.5).cast("int").alias("x")))
    held = rows.select(key, F.filter(x, lambda s: s.x != 0).alias("s"))
    return held.select(key, F.col("s.slot").alias("slots"), F.col("s.x").alias("x")).filter(F.size("x") > 0)


def fitted_sketches(texts: DataFrame, key: str, text: str, width: int = WIDTH,
                    common: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The terms of all ``texts`` and their sketches, both written.

    The words are counted once, in the row of their text, and sketched there.
    """
    counted = materialize(count_terms(texts.filter(F.col(key).isNotNull()), key, text), "embedding-counts")
    terms = materialize(_slots(document_frequency(counted), counted.count(), width), "embedding-terms")
    return terms, materialize(_counted_sketches(counted, terms, key, width, common or COMMON), "embedding-sketches")


def _counted_sketches(counted: DataFrame, terms: DataFrame, key: str, width: int, common: int) -> DataFrame:
    """The rows of :func:`sketches` from (key, terms): only the rare terms are sent to their weight and back."""
    known = terms.orderBy("idf", "term").limit(common).toArrow()  # at most ``common`` rows
    words, slots, signs, idf = (known.column(c).combine_chunks() for c in ("term", "slot", "sign", "idf"))
    kind = counted.schema[key].dataType.simpleString()
    rows = counted.select(F.col(key).alias("key"), "terms")
    weight = F.struct("slot", "sign", "idf")
    if terms.count() > len(words):
        rare = rows.mapInArrow(rare_terms(words), f"key {kind}, place int, term string")
        rare = rare.join(terms, "term").groupBy("key").agg(F.transform(F.array_sort(F.collect_list(
            F.struct("place", weight.alias("w")))), lambda x: x.w).alias("rare"))
        rows = rows.select("key", *packed_terms()).join(rare, "key", "left")
    else:
        rows = rows.withColumn("rare", F.lit(None).cast("array<struct<slot:int,sign:int,idf:double>>"))
    made = rows.mapInArrow(
        _sketch(words, slots, signs, idf, width), f"key {kind}, slots array<int>, x array<int>")
    return made.withColumnRenamed("key", key)


def _sketch(words, slots, signs, idf, width: int):
    """Rows (key, slots, x) of rows with key, terms and rare; ``rare`` has the weights of the terms not in ``words``, in order."""
    def run(batches):
        import math

        import pyarrow as pa
        import pyarrow.compute as pc
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(start, BLOCK_ROWS)
                row, term, tf = flat_terms(b)
                at = pc.index_in(term, value_set=words)
                far, rare = at.is_null().to_numpy(zero_copy_only=False), b.column("rare").flatten()
                slot, sign, weight = (np.array(x.take(at).fill_null(0)) for x in (slots, signs, idf))
                slot[far], sign[far], weight[far] = (np.array(rare.field(c)) for c in ("slot", "sign", "idf"))
                many, place = np.unique(tf, return_inverse=True)
                log = np.array([math.log(x) for x in many])[place]
                w = np.floor((1.0 + log) * weight * UNIT + 0.5)
                square = np.bincount(row, w * w, b.num_rows)
                v = np.bincount(row * width + slot, w * sign, b.num_rows * width).reshape(b.num_rows, width)
                x = np.floor(v * UNIT / np.sqrt(square)[:, None] + 0.5).astype("i4")
                r, s = np.nonzero(x)
                n = np.bincount(r, minlength=b.num_rows)
                kept = np.flatnonzero(n)
                offsets = pa.array(np.r_[0, np.cumsum(n[kept])], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").take(pa.array(kept)), pa.ListArray.from_arrays(offsets, pa.array(s, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(x[r, s], pa.int32()))], names=["key", "slots", "x"])
    return run


def _dense(batch, width: int):
    slots = batch.column("slots")
    n = slots.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((batch.num_rows, width))
    out[np.repeat(np.arange(batch.num_rows), n), slots.flatten().to_numpy(zero_copy_only=False)] = \
        batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return out


def _blocks(batches, width: int):
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            part = whole.slice(at, BLOCK_ROWS)
            yield part, _dense(part, width)


def _slot_rows(sums: dict):
    import pyarrow as pa
    slots = sorted(sums)
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array([sums[s] for s in slots],
                                                                             pa.list_(pa.int64()))], names=["slot", "g"])


def _products(width: int):
    """One row (slot, products with every slot) per slot that the task's sketches use."""
    def run(batches):
        total = np.zeros((width, width), "i8")
        for _, x in _blocks(batches, width):
            total += (x.T @ x).astype("i8")
        yield _slot_rows({int(s): total[s] for s in np.flatnonzero(total.any(axis=1))})
    return run


def _added(batches):
    """The sum per slot of the rows of a task, which holds all rows of its slots."""
    sums: dict = {}
    for b in batches:
        for slot, g in zip(b.column("slot").to_pylist(), b.column("g")):
            row = g.values.to_numpy(zero_copy_only=False)
            sums[slot] = sums[slot] + row if slot in sums else row.copy()
    yield _slot_rows(sums)


def gram(made: DataFrame, width: int = WIDTH) -> DataFrame:
    """(slot, g): the exact Gram matrix of all sketches, a row per slot in use.

    The number of tasks follows the cluster, not the table, since each hands on
    up to ``width`` x ``width`` numbers.
    """
    tasks = 4 * made.sparkSession.sparkContext.defaultParallelism
    parts = made.select("slots", "x").coalesce(tasks).mapInArrow(_products(width), "slot int, g array<long>")
    return parts.repartition("slot").mapInArrow(_added, "slot int, g array<long>")


def _project(projection: np.ndarray, keytype: str):
    width, dims = projection.shape

    def run(batches):
        import pyarrow as pa
        for part, x in _blocks(batches, width):
            y = x @ projection
            norm = np.sqrt((y * y).sum(axis=1))
            seen = np.flatnonzero(norm > 1e-6)
            y = np.round(y[seen] / norm[seen][:, None], PLACES) + 0.0
            held = pa.ListArray.from_arrays(pa.array(np.arange(len(seen) + 1) * dims, pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(seen)), held],
                                             names=["key", "embedding"])
    return run


@dataclass
class TextEmbedding:
    """The terms and the projection of a fitted embedding."""

    terms: DataFrame
    projection: np.ndarray  # width x dims
    spectrum: np.ndarray    # share of the squared length that each dimension holds

    @classmethod
    def fit(cls, texts: DataFrame, key: str = "chunk_id", text: str = "search_text", dims: int = DIMS,
            width: int = WIDTH) -> "tuple[TextEmbedding, DataFrame] | None":
        """The embedding fitted on all ``texts`` and their sketches, from which :meth:`project` takes vectors."""
        terms, made = fitted_sketches(texts, key, text, width)
        rows = gram(made, width).collect()  # width x width numbers
        if not rows:
            return None
        g = np.zeros((width, width))
        for r in rows:
            g[r.slot] = r.g
        values, vectors = np.linalg.eigh(g)
        lead = np.argsort(-values, kind="stable")[:dims]
        lead = lead[values[lead] > 1e-9 * max(values.max(), 1.0)]
        p = vectors[:, lead]
        p = p * np.where(p[np.abs(p).argmax(axis=0), np.arange(p.shape[1])] < 0, -1.0, 1.0)
        return cls(terms, p, values[lead] / np.trace(g)), made

    def project(self, made: DataFrame, key: str) -> DataFrame:
        """(key, embedding) of sketches; a sketch that the projection maps to zero has no vector."""
        kind = made.schema[key].dataType.simpleString()
        return made.select(F.col(key).alias("key"), "slots", "x").mapInArrow(
            _project(self.projection, kind), f"key {kind}, embedding array<double>").withColumnRenamed("key", key)

    def vectors(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """(key, embedding) of other texts, such as queries, by the fitted terms."""
        return self.project(sketches(postings(texts, key, text), self.terms, key), key)

    def save(self, path: str) -> None:
        """Write the model beside an index: ``terms`` and ``projection`` (one row a dimension)."""
        spark = self.terms.sparkSession
        self.terms.write.parquet(f"{path.rstrip('/')}/terms")
        rows = [(d, float(self.spectrum[d]), [float(v) for v in self.projection[:, d]])
                for d in range(self.projection.shape[1])]
        spark.createDataFrame(rows, "dim int, share double, weights array<double>").coalesce(1).write.parquet(
            f"{path.rstrip('/')}/projection")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TextEmbedding":
        rows = spark.read.parquet(f"{path.rstrip('/')}/projection").orderBy("dim").collect()  # DIMS rows
        return cls(spark.read.parquet(f"{path.rstrip('/')}/terms"), np.array([r.weights for r in rows]).T,
                   np.array([r.share for r in rows]))
