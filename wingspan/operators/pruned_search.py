"""Exact top-k search that reads only what can reach the top (TX9, TX10).

An impact is a term's share of a chunk's score: the BM25 weight of a posting,
or its TF-IDF weight over the chunk's norm.  A chunk's score for a query is the
sum of query weight x impact over the common terms, for either measure.

Index tables (parquet in the shared folder):

* ``vectors`` (key, dl, terms): the terms of a chunk with their counts, one row a
  chunk; impacts are worked out from the counts where they are read;
* ``norms`` (key, norm): the length of a chunk's TF-IDF vector, for the cosine only;
* ``postings`` (term, level, key, impact), one table per measure, made when the
  measure is first asked for.  A level is a logarithmic step of the impact (0 the
  highest); every batch of chunks writes its postings as a segment, sorted by term
  and falling impact, so a frequent term spans many files and none is shuffled;
* ``directory`` (term, level, n, most): the blocks of the postings with their
  largest impact, and the largest of the term.

The text is shuffled once, by document; postings stay in the tasks of their chunks.
What a query set brings to a join with an index table is counted and broadcast
up to BROADCAST_ROWS rows, so that the table itself stays where it lies.

A query set is answered in four joins:

1. seeds: the highest blocks of each query's rarest terms name some chunks;
   their exact scores give a threshold that the k-th best score reaches;
2. MaxScore: terms whose bounds together stay under SKIPPED_SHARE of the
   threshold (the most frequent ones) are not followed, and of the other terms
   only the blocks are read whose bound, with the bounds of all other terms,
   reaches the threshold; the smaller the share, the fewer chunks pass step 3.
   Where these blocks hold more postings than there are chunks, up to SCAN_QUERIES
   queries are summed in the rows of ``vectors`` instead, which shuffles no sum;
3. chunks whose sum so far plus the bounds of the terms not followed stays
   under the threshold are dropped;
4. the chunks left meet ``vectors`` on their key for the exact score.

A chunk in the top k passes all four, so the result equals the full scoring.
A query that fewer than k seed chunks answer has no threshold and is scored in full.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wingspan.operators.search import (BM25_B, BM25_K1, HYBRID_WINDOW, RRF_K, count_terms, document_frequency,
                                       flat_terms, packed_terms, query_terms, rare_terms, top_k)
from wingspan.session import materialize

LEVELS_PER_OCTAVE = 8
LAST_LEVEL = 255
SEED_CHUNKS = 256  # postings that the seed terms of a query should offer at least
SKIPPED_SHARE = 0.5  # share of the threshold that the bounds of the terms not followed may add up to
BROADCAST_ROWS = 250_000  # rows of a query set (terms, blocks, pairs) that are broadcast at most
FREQUENT_TERMS = 100_000  # terms whose weights are broadcast for the norms; the rarer ones are joined
SCAN_QUERIES = 4_096  # queries whose followed terms are summed where the chunks lie at most; more of them read postings
SCAN_CELLS = 1 << 21  # sums (query, chunk) that a task holds at once
SLACK = 1e-8  # scores this near the threshold are kept: ranks compare nine places

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of the package


def _weighed(batch, terms, weights):
    """Row, term, count and TF-IDF weight of every posting; the weights of rare terms lie in the row."""
    import pyarrow.compute as pc
    row, term, tf = flat_terms(batch)
    at = pc.index_in(term, value_set=terms)
    weight = np.array(weights.take(at).to_numpy(zero_copy_only=False), dtype="f8")
    weight[at.is_null().to_numpy(zero_copy_only=False)] = batch.column("rare").flatten().to_numpy(zero_copy_only=False)
    return row, term, tf, weight


def _norms(terms, weights):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            row, _, tf, weight = _weighed(b, terms, weights)
            square = np.bincount(row, np.square(tf * weight), b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("rare"), pa.array(np.sqrt(square))],
                                             names=["key", "rare", "norm"])
    return run


def _keyword_impact(tf, dl, avgdl: float):
    return tf * (BM25_K1 + 1) / (tf + (BM25_K1 * (1 - BM25_B + BM25_B * dl / avgdl)))


def _segments(terms, weights, avgdl: float, cap: float):
    """The postings of each batch, sorted by term and falling impact, with a logarithmic level below ``cap``."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            if terms is None:
                row, term, tf = flat_terms(b)
                impact = _keyword_impact(tf, b.column("dl").to_numpy(zero_copy_only=False)[row], avgdl)
            else:
                row, term, tf, weight = _weighed(b, terms, weights)
                impact = tf / b.column("norm").to_numpy(zero_copy_only=False)[row] * weight
            coded = term.dictionary_encode()
            rank = np.empty(len(coded.dictionary), "i8")
            rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
            order = np.lexsort((-impact, rank[coded.indices.to_numpy()]))
            impact = impact[order]
            level = np.clip(np.floor(LEVELS_PER_OCTAVE * np.log2(cap / impact)), 0, LAST_LEVEL)
            yield pa.RecordBatch.from_arrays(
                [term.take(pa.array(order)), pa.array(level.astype("i4")), b.column("key").take(pa.array(row[order])),
                 pa.array(impact)], names=["term", "level", "key", "impact"])
    return run


def _reached(rows, limits, avgdl: float, kind):
    """(query, key) of the chunks that reach the query's limit, summed in the chunk's row.

    ``rows`` are (query, term, weight, followed), ``limits`` (query, theta, skipped).  The followed
    terms are summed first, the others where they leave a chunk that may reach the limit.
    """
    import pyarrow as pa
    limits = [r for r in limits if r[0] is not None]
    place = {r[0]: i for i, r in enumerate(limits)}
    rows = sorted((r[1], place[r[0]], r[2], r[3]) for r in rows if r[0] in place)
    names, n = pa.array([r[0] for r in limits], kind), len(limits)
    theta, skipped = (np.array([r[i] for r in limits], "f8") for i in (1, 2))

    def by_term(some):
        words = sorted({r[0] for r in some})
        code = {w: i for i, w in enumerate(words)}
        size = np.bincount(np.array([code[r[0]] for r in some], "i8"), minlength=len(words))
        return (pa.array(words, pa.string()), size, np.cumsum(size) - size, np.array([r[1] for r in some], "i8"),
                np.array([r[2] for r in some], "f8"))
    followed, others = by_term([r for r in rows if r[3]]), by_term([r for r in rows if not r[3]])

    def sums(b, asked):
        import pyarrow.compute as pc
        vocabulary, size, start, asks, weight = asked
        row, term, tf = flat_terms(b)
        found = pc.index_in(term, value_set=vocabulary)
        some = found.is_valid().to_numpy(zero_copy_only=False)
        row, tf, met = row[some], tf[some], found.drop_null().to_numpy(zero_copy_only=False).astype("i8")
        other = b.column("other").to_numpy(zero_copy_only=False)[row]  # the chunk's length or norm
        impact = _keyword_impact(tf, other, avgdl) if avgdl else tf / other
        many = size[met]
        pair = np.repeat(start[met] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.bincount(np.repeat(row * n, many) + asks[pair], np.repeat(impact, many) * weight[pair],
                           b.num_rows * n).reshape(b.num_rows, n)

    def run(batches):
        for whole in batches:
            step = max(1, SCAN_CELLS // max(1, n))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                part = sums(b, followed)
                may = (part > 0) & (part + skipped >= theta)
                left = np.flatnonzero(may.any(axis=1))
                if not len(left):
                    continue
                b, part, may = b.take(pa.array(left)), part[left], may[left]
                r, q = np.nonzero(may & (part + sums(b, others) >= theta))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(q)), b.column("key").take(pa.array(r))],
                                                 names=["query", "key"])
    return run


def _asked(df: DataFrame, name: str) -> DataFrame:
    """Rows of a query set, written once; broadcast where their counted number allows it."""
    made = materialize(df, name)
    return F.broadcast(made) if made.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else made


@dataclass
class ImpactIndex:
    """Impact-ordered postings, their block directory and the chunk vectors of a corpus."""

    key: str
    vectors: DataFrame
    idf: DataFrame
    n_docs: int
    avgdl: float
    _made: dict = field(default_factory=dict)

    @classmethod
    def build(cls, chunks: DataFrame, key: str = "chunk_key", text: str = "search_text",
              cluster_key: str | None = "doc_id") -> "ImpactIndex":
        if cluster_key not in chunks.columns:
            cluster_key = None
        vectors = materialize(count_terms(chunks, key, text, cluster_key), "impact-vectors")
        size = vectors.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
        n, avgdl = int(size.n), float(size.avgdl or 1.0)
        idf = materialize(document_frequency(vectors).select(
            "term", "df", F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0).alias("keyword"),
            (F.log((1.0 + F.lit(n)) / (1.0 + F.col("df"))) + 1.0).alias("vector")), "impact-idf")
        return cls(key, vectors, idf, n, avgdl)

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = materialize(make(), name)
        return self._made[name]

    def _frequent(self) -> tuple[list, list]:
        """The terms of the most chunks, at most FREQUENT_TERMS, and their TF-IDF weights."""
        if "impact-frequent" not in self._made:
            rows = self.idf.orderBy(F.col("df").desc(), "term").limit(FREQUENT_TERMS).select("term", "vector").toArrow()
            self._made["impact-frequent"] = tuple(rows.column(c).combine_chunks() for c in ("term", "vector"))
        return self._made["impact-frequent"]

    def norms(self) -> DataFrame:
        """(key, rare, norm) of the chunks: ``rare`` has the weights of the terms that are not broadcast, in their order.

        Only the postings of those terms are shuffled, to their weight and back.
        """
        def make():
            terms, weights = self._frequent()
            each = self.vectors.select(F.col(self.key).alias("key"), "terms")
            if self.idf.count() > len(terms):
                kind = self.vectors.schema[self.key].dataType.simpleString()
                rare = each.mapInArrow(rare_terms(terms), f"key {kind}, place int, term string")
                rare = rare.join(self.idf.select("term", "vector"), "term").groupBy("key").agg(F.transform(
                    F.array_sort(F.collect_list(F.struct("place", "vector"))), lambda x: x.vector).alias("rare"))
                each = each.select("key", *packed_terms()).join(rare, "key", "left")
            else:
                each = each.withColumn("rare", F.lit(None).cast("array<double>"))
            kind = each.schema["key"].dataType.simpleString()
            return each.mapInArrow(
                _norms(terms, weights), f"key {kind}, rare array<double>, norm double").withColumnRenamed("key", self.key)
        return self._once("impact-norms", make)

    def postings(self, measure: str) -> DataFrame:
        """(term, level, key, impact) of a measure; a batch of chunks is a segment, sorted by term and falling impact."""
        def make():
            kind = self.vectors.schema[self.key].dataType.simpleString()
            schema = f"term string, level int, key {kind}, impact double"
            if measure == "keyword":
                rows = self.vectors.select(F.col(self.key).alias("key"), "terms", "dl").mapInArrow(
                    _segments(None, None, self.avgdl, BM25_K1 + 1), schema)
            else:
                rows = self.vectors.select(self.key, *packed_terms()).join(
                    self.norms(), self.key).withColumnRenamed(self.key, "key").mapInArrow(
                    _segments(*self._frequent(), self.avgdl, 1.0), schema)
            return rows.withColumnRenamed("key", self.key)
        return self._once(f"impact-{measure}", make)

    def directory(self, measure: str) -> DataFrame:
        """(term, level, n, most, term_most, before): the blocks of a measure's postings."""
        def make():
            blocks = self.postings(measure).groupBy("term", "level").agg(F.count(F.lit(1)).alias("n"),
                                                                         F.max("impact").alias("most"))
            per_term = Window.partitionBy("term")  # at most LAST_LEVEL + 1 rows a term
            return blocks.select("*", F.max("most").over(per_term).alias("term_most"), F.coalesce(
                F.sum("n").over(per_term.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0)).alias("before"))
        return self._once(f"impact-blocks-{measure}", make)

    def weights(self, queries: DataFrame, measure: str, qkey: str = "query_id") -> DataFrame:
        """(query, term, weight, df, bound) of the query terms that the corpus has."""
        q = _asked(query_terms(queries, qkey), "impact-asked").join(self.idf, "term")
        if measure == "keyword":
            q = q.select(qkey, "term", "df", F.col("keyword").alias("weight"))
        else:
            raw = F.col("qtf") * F.col("vector")
            norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(qkey)))  # a query's own terms
            q = q.select(qkey, "term", "df", (raw / norm).alias("weight"))
        q = _asked(q, "impact-known")
        most = self.directory(measure).filter(F.col("before") == 0).select("term", "term_most")
        return q.join(most, "term").select(qkey, "term", "df", "weight",
                                           (F.col("weight") * F.col("term_most")).alias("bound"))

    def exact(self, pairs: DataFrame, weights: DataFrame, measure: str, qkey: str = "query_id") -> DataFrame:
        """Exact scores of (query, key) pairs: one row a pair meets the chunk's vector and the query's weights."""
        factor = F.col("weight")
        if measure == "vector":  # the idf of the chunk's side
            factor = factor * (F.log((1.0 + F.lit(self.n_docs)) / (1.0 + F.col("df"))) + 1.0)
        asked = weights.groupBy(qkey).agg(F.map_from_entries(F.collect_list(F.struct("term", factor.alias("f")))).alias("qw"))
        pairs = _asked(pairs, "impact-pairs")
        met = self.vectors.join(pairs, self.key).join(asked, qkey)
        impact = (lambda t: _keyword_impact(t.tf, F.col("dl"), F.lit(self.avgdl))) if measure == "keyword" else lambda t: t.tf
        weight = lambda t: F.coalesce(F.try_element_at("qw", t.term), F.lit(0.0))
        met = met.select(qkey, self.key, F.aggregate("terms", F.lit(0.0), lambda s, t: s + weight(t) * impact(t)).alias("score"))
        if measure == "keyword":
            return met
        return met.join(self.norms().join(pairs.select(self.key).distinct(), self.key, "left_semi"), self.key).select(
            qkey, self.key, (F.col("score") / F.col("norm")).alias("score"))

    def thresholds(self, weights: DataFrame, measure: str, k: int, qkey: str = "query_id",
                   seeds: int = SEED_CHUNKS) -> DataFrame:
        """(query, theta): a score that at least k chunks reach, for queries where the seeds offer k chunks."""
        rare = Window.partitionBy(qkey).orderBy(F.col("weight").desc(), "term")
        offered = F.sum(F.least(F.col("df"), F.lit(seeds))).over(rare.rowsBetween(Window.unboundedPreceding, -1))
        first = weights.withColumn("offered", F.coalesce(offered, F.lit(0))).filter(F.col("offered") < seeds)
        blocks = _asked(first, "impact-first").join(self.directory(measure).filter(F.col("before") < seeds), "term")
        met = self.postings(measure).join(_asked(blocks.select(qkey, "term", "level"), "impact-seeds"), ["term", "level"])
        best = Window.partitionBy(qkey, "term").orderBy(F.col("impact").desc(), self.key)
        some = met.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= seeds).select(qkey, self.key)
        scored = self.exact(some.distinct(), weights, measure, qkey)
        return (top_k(scored, k, qkey, [F.col("score").desc(), F.col(self.key)], "r").filter(F.col("r") == k)
                .select(qkey, (F.col("score") - SLACK).alias("theta")))

    def candidates(self, weights: DataFrame, theta: DataFrame, measure: str, qkey: str = "query_id",
                   skipped_share: float = SKIPPED_SHARE) -> DataFrame:
        """(query, key) of every chunk whose score can reach the threshold of its query."""
        up = Window.partitionBy(qkey).orderBy("bound", "term")
        terms = (weights.join(theta, qkey, "left").withColumns({
            "theta": F.coalesce("theta", F.lit(float("-inf"))),
            "under": F.sum("bound").over(up.rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.sum("bound").over(Window.partitionBy(qkey))}))
        terms = _asked(terms.withColumn("followed", F.col("under") >= F.col("theta") * skipped_share), "impact-terms")
        skipped = terms.groupBy(qkey, "theta").agg(
            F.coalesce(F.sum(F.when(~F.col("followed"), F.col("bound"))), F.lit(0.0)).alias("skipped"))
        blocks = (terms.filter("followed").join(self.directory(measure), "term")
                  .filter(F.col("weight") * F.col("most") + F.col("total") - F.col("bound") >= F.col("theta"))
                  .select(qkey, "term", "level", "weight", "n"))
        blocks = _asked(blocks, "impact-read")
        if (self._read_rows(blocks) > self.n_docs and terms.count() <= BROADCAST_ROWS
                and skipped.count() <= SCAN_QUERIES):
            return self._scanned(terms, skipped, measure, qkey)
        found = (self.postings(measure).join(blocks.drop("n"), ["term", "level"]).groupBy(qkey, self.key)
                 .agg(F.sum(F.col("weight") * F.col("impact")).alias("part")))
        return (found.join(skipped, qkey).filter(F.col("part") + F.col("skipped") >= F.col("theta"))
                .select(qkey, self.key))

    def _read_rows(self, blocks: DataFrame) -> int:
        return int(blocks.agg(F.sum("n")).first()[0] or 0)

    def _scanned(self, terms: DataFrame, skipped: DataFrame, measure: str, qkey: str) -> DataFrame:
        """The same candidates where the blocks hold more postings than there are chunks.

        The chunks' terms meet the query terms in their row, so no sum is shuffled.
        """
        weight = F.col("weight")
        if measure == "keyword":
            rows = self.vectors.select(F.col(self.key).alias("key"), "terms", F.col("dl").cast("double").alias("other"))
        else:
            weight = weight * (F.log((1.0 + F.lit(self.n_docs)) / (1.0 + F.col("df"))) + 1.0)
            rows = self.vectors.select(self.key, *packed_terms()).join(
                self.norms().select(self.key, F.col("norm").alias("other")), self.key).withColumnRenamed(self.key, "key")
        kind = terms.schema[qkey].dataType
        run = _reached(terms.select(qkey, "term", weight, "followed").collect(), skipped.select(qkey, "theta", "skipped").collect(),
                       self.avgdl if measure == "keyword" else 0.0, to_arrow_type(kind))
        found = rows.mapInArrow(run, f"query {kind.simpleString()}, key {rows.schema['key'].dataType.simpleString()}")
        return found.select(F.col("query").alias(qkey), F.col("key").alias(self.key))

    def top(self, queries: DataFrame, k: int, measure: str = "keyword", qkey: str = "query_id",
            rank_col: str = "rank") -> DataFrame:
        """(query, key, score, rank): the k best chunks, by the score to nine places, then the key."""
        weights = materialize(self.weights(queries, measure, qkey), "impact-weights")
        theta = materialize(self.thresholds(weights, measure, k, qkey), "impact-theta")
        pairs = self.candidates(weights, theta, measure, qkey)
        scored = self.exact(pairs, weights, measure, qkey)
        return top_k(scored, k, qkey, [F.round("score", 9).desc(), F.col(self.key)], rank_col)

    def hybrid(self, queries: DataFrame, k: int, qkey: str = "query_id", window: int | None = None) -> DataFrame:
        """TX10: reciprocal-rank fusion of both pruned rankings; ``window`` hits of each (at least 2 x k)."""
        window = window or max(HYBRID_WINDOW, 2 * k)
        a = self.top(queries, window, "keyword", qkey, "r_kw").select(qkey, self.key, "r_kw")
        b = self.top(queries, window, "vector", qkey, "r_vec").select(qkey, self.key, "r_vec")
        fused = a.join(b, [qkey, self.key], "full").select(qkey, self.key, (
            F.coalesce(1.0 / (RRF_K + F.col("r_kw")), F.lit(0.0))
            + F.coalesce(1.0 / (RRF_K + F.col("r_vec")), F.lit(0.0))).alias("score"))
        return top_k(fused, k, qkey, [F.round("score", 9).desc(), F.col(self.key)])
