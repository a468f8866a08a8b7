"""Keyword, vector and hybrid search over chunks (TX7-TX13, UN6).

Index: (term, chunk_id, tf) rows from ``explode`` of the tokenised text,
plus per-chunk length and per-term document frequency.  A query set is a
DataFrame (one row per query) so many queries are answered by one join
on ``term``; hot terms are handled by AQE's skew-join split, and top-k
per query is a ``row_number() <= k`` filter, which Spark plans as a
partial group limit before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wingspan.operators.text import tokens
from wingspan.session import materialize as materialize_table

BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
HYBRID_WINDOW = 50  # least number of hits each retriever hands to the fusion

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of the package


def term_index(chunks: DataFrame, key: str = "chunk_id", text: str = "search_text",
               cluster_key: str | None = None) -> DataFrame:
    """(key, term, tf) postings.

    ``cluster_key`` names a column the key depends on (a chunk's document
    id).  Grouping by it as well yields the same groups, and when the
    chunks are already hash-partitioned by it Spark needs no shuffle for
    the term counts.
    """
    keys = ([cluster_key] if cluster_key else []) + [key]
    out = (chunks.select(*keys, F.explode(tokens(F.col(text))).alias("term"))
           .filter(F.length("term") > 0)
           .groupBy(*keys, "term").agg(F.count(F.lit(1)).cast("bigint").alias("tf")))
    return out.drop(cluster_key) if cluster_key else out


def _counted(batches):
    """Rows (key, words) to (key, dl, terms) by ascending term; rows without a word give none."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    for b in batches:
        words = b.column(1)
        n = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat, row = words.flatten(), np.repeat(np.arange(b.num_rows), n)
        some = pc.greater(pc.binary_length(flat), 0).fill_null(False)
        flat, row = flat.filter(some).dictionary_encode(), row[some.to_numpy(zero_copy_only=False)]
        if not len(row):
            continue
        order = pc.sort_indices(flat.dictionary).to_numpy()
        rank = np.empty(len(order), "i8")
        rank[order] = np.arange(len(order))
        each, tf = np.unique(row * len(order) + rank[flat.indices.to_numpy()], return_counts=True)
        at, size = np.unique(each // len(order), return_counts=True)
        terms = pa.StructArray.from_arrays([flat.dictionary.take(pa.array(order[each % len(order)])), pa.array(tf, pa.int64())],
                                           names=["term", "tf"])
        held = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), terms)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.bincount(row)[at], pa.int64()), held],
                                         names=["key", "dl", "terms"])


def packed_terms() -> list:
    """The column ``terms`` as one string and its counts: less than half of the bytes where rows are shuffled."""
    return [F.concat_ws(" ", "terms.term").alias("words"), F.col("terms.tf").cast("array<int>").alias("counts")]


def flat_terms(batch):
    """Row, term and count of every posting of a batch with the column ``terms`` or its packed form."""
    import numpy as np
    import pyarrow.compute as pc
    packed = "words" in batch.schema.names
    terms = pc.split_pattern(batch.column("words"), " ") if packed else batch.column("terms")  # words hold no space
    row = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy(zero_copy_only=False))
    each = terms.flatten()
    term, tf = (each, batch.column("counts").flatten()) if packed else (each.field("term"), each.field("tf"))
    return row, term, tf.to_numpy(zero_copy_only=False).astype("f8")


def rare_terms(terms):
    """(key, place, term) of the postings whose term is not among ``terms``."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            row, term, _ = flat_terms(b)
            at = np.flatnonzero(pc.index_in(term, value_set=terms).is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(row[at])), pa.array(at, pa.int32()),
                                              term.take(pa.array(at))], names=["key", "place", "term"])
    return run


def _term_counts(batches):
    import pyarrow as pa
    import pyarrow.compute as pc
    for b in batches:
        n = pc.value_counts(b.column(0).flatten())
        yield pa.RecordBatch.from_arrays([n.field("values"), n.field("counts")], names=["term", "df"])


def count_terms(chunks: DataFrame, key: str, text: str, cluster_key: str | None = None) -> DataFrame:
    """(key, dl, terms): the terms of every text with a word and their counts, sorted, one row a key.

    The texts are dealt by the key (or what it depends on) once; words are counted in their row.
    """
    near = list(dict.fromkeys([cluster_key or key, key]))
    texts = chunks.select(*near, text).repartition(near[0]).groupBy(*near).agg(F.collect_list(text).alias("texts"))
    kind = texts.schema[key].dataType.simpleString()
    words = texts.select(F.col(key).alias("key"), F.flatten(F.transform("texts", tokens)).alias("words"))
    return words.mapInArrow(_counted, f"key {kind}, dl bigint, terms array<struct<term:string,tf:bigint>>"
                            ).withColumnRenamed("key", key)


def document_frequency(counted: DataFrame) -> DataFrame:
    """(term, df) of rows (terms) in which a term stands once; counted by the batch before the shuffle."""
    return (counted.select("terms.term").mapInArrow(_term_counts, "term string, df bigint")
            .groupBy("term").agg(F.sum("df").alias("df")))


def query_terms(queries: DataFrame, qkey: str = "query_id", text: str = "query_text") -> DataFrame:
    return (queries.select(qkey, F.explode(tokens(F.col(text))).alias("term"))
            .filter(F.length("term") > 0)
            .groupBy(qkey, "term").agg(F.count(F.lit(1)).cast("bigint").alias("qtf")))


@dataclass
class SearchIndex:
    """Keyword + vector index over chunks, built once (TX7, TX9, TX13).

    Tables (written as parquet into the shared checkpoint dir, so the
    tokenisation runs once and retried tasks re-read files):

    * ``postings`` (key, term, tf, bm25_tf, w): per posting the BM25 term
      weight ``tf (k1+1) / (tf + k1 (1 - b + b dl/avgdl))`` and the TF-IDF
      weight, so a query only multiplies by the term's idf and sums;
    * ``lengths`` (key, dl, norm); ``doc_freq`` (term, df, idf_bm25, idf_tfidf).

    ``key`` is any orderable column, such as the (doc_id, pos) pair of a chunk.
    """

    key: str
    postings: DataFrame
    lengths: DataFrame
    doc_freq: DataFrame
    n_docs: int
    avgdl: float

    @classmethod
    def build(cls, chunks: DataFrame, key: str = "chunk_key", text: str = "search_text",
              materialize: bool = True, cluster_key: str | None = "doc_id") -> "SearchIndex":
        keep = (lambda df, n: materialize_table(df, n)) if materialize else (lambda df, n: df)
        if cluster_key not in chunks.columns:
            cluster_key = None
        post = keep(term_index(chunks, key, text, cluster_key), "postings_tf")
        dl = post.groupBy(key).agg(F.sum("tf").alias("dl"))
        stats = dl.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
        n_docs, avgdl = int(stats["n"]), float(stats["avgdl"] or 0.0)
        df_t = keep(post.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumns({
            "idf_bm25": F.log((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0),
            "idf_tfidf": F.log((1.0 + F.lit(n_docs)) / (1.0 + F.col("df"))) + 1.0}), "doc_freq")
        tfn = F.col("tf") * (BM25_K1 + 1) / (
            F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / F.lit(avgdl)))
        full = (post.join(df_t.select("term", "idf_tfidf"), "term").join(dl, key)
                .select(key, "term", "tf", tfn.alias("bm25_tf"),
                        (F.col("tf") * F.col("idf_tfidf")).alias("w"), "dl"))
        full = keep(full, "postings")
        lengths = keep(full.groupBy(key).agg(F.first("dl").alias("dl"),
                                             F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")),
                       "lengths")
        return cls(key, full.drop("dl"), lengths, df_t, n_docs, avgdl)

    def bm25(self, queries: DataFrame, qkey: str = "query_id") -> DataFrame:
        """BM25 of every chunk sharing a term with each query: (query, key, score)."""
        qt = query_terms(queries, qkey).select(qkey, "term").join(
            self.doc_freq.select("term", "idf_bm25"), "term")
        hits = qt.join(self.postings.select(self.key, "term", "bm25_tf"), "term")
        return hits.groupBy(qkey, self.key).agg(
            F.sum(F.col("idf_bm25") * F.col("bm25_tf")).alias("score"))

    def cosine(self, queries: DataFrame, qkey: str = "query_id") -> DataFrame:
        """TF-IDF cosine (sparse dot product by a term join): (query, key, score)."""
        key = self.key
        q = query_terms(queries, qkey).join(self.doc_freq.select("term", "idf_tfidf"), "term") \
            .withColumn("qw", F.col("qtf") * F.col("idf_tfidf"))
        qnorm = q.groupBy(qkey).agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
        dot = (q.select(qkey, "term", "qw").join(self.postings.select(key, "term", "w"), "term")
               .groupBy(qkey, key).agg(F.sum(F.col("qw") * F.col("w")).alias("dot")))
        return (dot.join(self.lengths.select(key, "norm"), key).join(qnorm, qkey)
                .select(qkey, key, (F.col("dot") / (F.col("norm") * F.col("qnorm"))).alias("score")))


def bm25_scores(chunks: DataFrame, queries: DataFrame, key: str = "chunk_key",
                qkey: str = "query_id") -> DataFrame:
    return SearchIndex.build(chunks, key).bm25(queries, qkey)


def tfidf_cosine(chunks: DataFrame, queries: DataFrame, key: str = "chunk_key",
                 qkey: str = "query_id") -> DataFrame:
    return SearchIndex.build(chunks, key).cosine(queries, qkey)


def top_k(scores: DataFrame, k: int, qkey: str = "query_id", order=None,
          rank_col: str = "rank") -> DataFrame:
    """row_number() <= k per query (planned with a partial group limit)."""
    order = order or [F.col("score").desc()]
    w = Window.partitionBy(qkey).orderBy(*order)
    return scores.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def hybrid(bm25: DataFrame, vec: DataFrame, k: int, key: str, qkey: str = "query_id",
           tie: list | None = None, window: int | None = None) -> DataFrame:
    """TX10: reciprocal-rank fusion of the top-``window`` of each retriever.

    ``window`` defaults to the larger of ``HYBRID_WINDOW`` and 2 x ``k``, so
    the fused list is never shorter than the hits allow.
    """
    tie = tie or [F.col(key)]
    window = window or max(HYBRID_WINDOW, 2 * k)
    a = top_k(bm25, window, qkey, [F.col("score").desc(), *tie], "r_kw").select(qkey, key, "r_kw")
    b = top_k(vec, window, qkey, [F.col("score").desc(), *tie], "r_vec").select(qkey, key, "r_vec")
    f = a.join(b, [qkey, key], "full").withColumn(
        "score", F.coalesce(1.0 / (RRF_K + F.col("r_kw")), F.lit(0.0))
        + F.coalesce(1.0 / (RRF_K + F.col("r_vec")), F.lit(0.0)))
    return top_k(f, k, qkey, [F.col("score").desc(), *tie])


def facets(chunks: DataFrame, cols: list[str]) -> DataFrame:
    """TX11 / UN6: distinct non-empty values per facet with chunk counts, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in cols])
    return (chunks.select(F.explode(pairs).alias("f")).select("f.facet", "f.value")
            .filter(F.col("value").isNotNull() & (F.col("value") != ""))
            .groupBy("facet", "value").agg(F.count(F.lit(1)).cast("bigint").alias("n_chunks")))


def changed_rows(old: DataFrame, new: DataFrame, key: str, content: str) -> DataFrame:
    """SNK12 / TX13: inserted, deleted and updated keys by content hash (one full outer join)."""
    h = F.unhex(F.sha2(F.col(content), 256))  # half of the hexadecimal form, which is shuffled
    o = old.select(key, h.alias("h_old"), F.lit(True).alias("in_old"))
    n = new.select(key, h.alias("h_new"), F.lit(True).alias("in_new"))
    change = (F.when(F.col("in_old").isNull(), "inserted").when(F.col("in_new").isNull(), "deleted")
              .when(~F.col("h_old").eqNullSafe(F.col("h_new")), "updated"))
    return (o.join(n, key, "full").withColumn("change", change).filter(F.col("change").isNotNull())
            .select(key, "change"))


def search(chunks: DataFrame, query_text: str, k: int = 8, filters: dict | None = None,
           mode: str = "HYBRID") -> DataFrame:
    """TX12: one query string with equality filters (FLT8); returns the top-k chunks."""
    spark = chunks.sparkSession
    for c, v in (filters or {}).items():
        chunks = chunks.filter(F.col(c) == F.lit(v))
    q = spark.createDataFrame([(0, query_text)], "query_id int, query_text string")
    tie = [F.col("chunk_key")]
    idx = SearchIndex.build(chunks)
    if mode == "KEYWORD":
        out = top_k(idx.bm25(q), k, order=[F.col("score").desc(), *tie])
    elif mode == "ANN":
        out = top_k(idx.cosine(q), k, order=[F.col("score").desc(), *tie])
    else:
        out = hybrid(idx.bm25(q), idx.cosine(q), k, "chunk_key")
    return out.join(chunks, "chunk_key").orderBy("rank")


def label_centroid_topk(vectors: DataFrame, k: int, key: str = "vec_id", vec: str = "embedding",
                        group: str = "label", score_places: int = 9) -> DataFrame:
    """Exact cosine top-k of each group's vectors to the group centroid.

    The centroid of a group is one array row; vectors meet it as arrays
    (dot products in place, nothing exploded but for the component means).
    Rank by the score rounded to ``score_places``, then the key.
    """
    means = (vectors.select(group, F.posexplode(vec).alias("pos", "x")).groupBy(group, "pos")
             .agg(F.avg("x").alias("c")).groupBy(group)
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda p: p.c).alias("centroid")))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    j = vectors.select(key, group, vec).join(means, group)
    v, c = F.col(vec), F.col("centroid")
    s = j.select(key, group, F.try_divide(dot(v, c), F.sqrt(dot(v, v)) * F.sqrt(dot(c, c))).alias("score"))
    return top_k(s, k, group, [F.round("score", score_places).desc(), F.col(key)])
