"""Approximate nearest neighbours over an embedding column (TX8).

An inverted file with product-quantised residuals, then exact re-ranking:

* **fit**: coarse centroids and one codebook per slice of ``SLICE``
  components, by Lloyd's algorithm on at most ``FIT_ROWS`` vectors (those of
  the smallest key hashes).  The model is bounded: ``MAX_LISTS`` centroids and
  256 entries per slice travel with the tasks.
* **index**: every vector gets its list and one byte per slice.  Tasks write
  blocks (list, keys, codes) of their own rows, so the index needs no shuffle
  and a list with a third of all rows is many blocks.
* **search**: tasks group their queries by probed list, meet the blocks by a
  join on the list (a hot list is split by AQE, its blocks are rows of their
  own), keep the best ``depth`` of each block, then of each query; those
  candidates are scored by the exact cosine.
* **calibrate**: ``nprobe`` and ``depth`` are the smallest that find
  ``target`` of the exact neighbours of at most ``CALIBRATION_QUERIES``
  queries, searched exactly against every row.  The queries are vectors of the
  table, or a caller's where queries are spread otherwise than the table.  Of
  fewer queries a smaller share may be lost, since they say less of others.

Vectors that are null, of another length than most of the fitted sample, hold
null or non-finite components or are zero take no part.  Ties go to the
smaller key.  An empty table has an empty index and an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wingspan.session import materialize

FIT_ROWS = 16_384
MAX_LISTS = 1_024
SLICE = 4
CODES = 256
CALIBRATION_QUERIES = 128
MAX_DEPTH = 1_024
TARGET = 0.96
BLOCK_ROWS = 65_536
QUERY_ROWS = 512
MERGE_ROWS = 1_000_000


def unit_vectors(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, unit): the vectors that can take part, at length 1; of repeated keys one stays."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x))
    return (vectors.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), v.alias("_v"))
            .withColumn("_n", norm).filter((F.col("_n") > 0) & (F.col("_n") < float("inf")))
            .select("key", F.transform("_v", lambda x: x / F.col("_n")).alias("unit"))
            .groupBy("key").agg(F.min("unit").alias("unit")))


def _sample(units: DataFrame, rows: int, name: str) -> DataFrame:
    """The rows of the smallest hashes of key and ``name``; samples of two names are drawn apart."""
    return units.orderBy(F.xxhash64("key", F.lit(name)), "key").limit(rows)


def _lloyd(rounds: int, size: int):
    """Grouped-map function: at most ``size`` centroids of the group's points."""
    def fit(pdf):
        import numpy as np
        import pandas as pd
        x = np.stack(pdf["x"].to_numpy()).astype("f8")
        _, first = np.unique(x, axis=0, return_index=True)
        c = x[np.sort(first)[:size]].copy()
        for _ in range(rounds):
            half = (c * c).sum(1) / 2
            near = np.concatenate([(x[i:i + 2048] @ c.T - half).argmax(1) for i in range(0, len(x), 2048)])
            n = np.bincount(near, minlength=len(c))
            sums = np.zeros_like(c)
            np.add.at(sums, near, x)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)  # an empty one stays where it was
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])] * len(c), "pos": range(len(c)), "c": list(c)})
    return fit


def _fit_parts(points: DataFrame, rounds: int, size: int) -> dict[int, np.ndarray]:
    """Centroids of every part of (part, x); a part is one bounded group."""
    rows = (points.groupBy("part").applyInPandas(_lloyd(rounds, size), "part int, pos int, c array<double>")
            .orderBy("part", "pos").collect())  # bounded by parts x size
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r.part, []).append(r.c)
    return {p: np.array(c) for p, c in out.items()}


@dataclass
class AnnIndex:
    units: DataFrame
    blocks: DataFrame
    dim: int
    coarse: np.ndarray  # lists x dim
    books: np.ndarray   # slices x CODES x SLICE
    nprobe: int = 1
    depth: int = MAX_DEPTH

    @classmethod
    def build(cls, vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 10,
              target: float = TARGET, fit_rows: int = FIT_ROWS, rounds: int = 10,
              asked: DataFrame | None = None) -> "AnnIndex | None":
        """Fitted, filled and calibrated index over every vector; None where no vector can take part."""
        units = materialize(unit_vectors(vectors, key, vec), "ann-units")
        sample = materialize(_sample(units, fit_rows, "fit"), "ann-sample")
        usual = (sample.groupBy(F.size("unit").alias("d")).count().orderBy(F.desc("count"), "d").first())
        if usual is None:
            return None
        dim = int(usual.d)
        units = units.filter(F.size("unit") == dim)
        sample = sample.filter(F.size("unit") == dim)
        lists = int(min(MAX_LISTS, max(1, round(units.count() ** 0.5))))
        coarse = _fit_parts(sample.select(F.lit(0).alias("part"), F.col("unit").alias("x")), rounds, lists)[0]
        near, slices = _residuals(coarse, dim)
        parts = sample.select("unit").mapInPandas(near, "part int, x array<double>")
        fitted = _fit_parts(parts, rounds, CODES)
        books = np.zeros((slices, CODES, SLICE))
        for p, c in fitted.items():
            books[p, :len(c)] = c
            books[p, len(c):] = c[0]
        keytype = units.schema["key"].dataType.simpleString()
        blocks = materialize(units.mapInArrow(
            _encode(coarse, books), f"list int, keys array<{keytype}>, codes binary"), "ann-blocks")
        out = cls(units, blocks, dim, coarse, books)
        out.calibrate(k, target, asked)
        return out

    def calibrate(self, k: int, target: float, asked: DataFrame | None = None) -> None:
        """Set ``nprobe`` and ``depth`` from the exact neighbours of a bounded query sample.

        The sample is drawn from ``asked`` (query, unit) where it has rows of
        the index's length, else from the table.
        """
        own = self.units.select(F.col("key").alias("query"), "unit")
        given = None if asked is None else asked.select("query", "unit").filter(F.size("unit") == self.dim)
        source = own if given is None or given.isEmpty() else given
        queries = materialize(_sample(source.withColumnRenamed("query", "key"), CALIBRATION_QUERIES, "calibrate")
                              .withColumnRenamed("key", "query"), "ann-calibration")
        exact = materialize(exact_top(self.units, queries, k), "ann-exact")
        near = exact.join(queries, "query").join(self.units.select("key", F.col("unit").alias("v")), "key")
        rows = near.select("unit", "v").collect()  # at most CALIBRATION_QUERIES x k
        if not rows:
            return
        half = (self.coarse ** 2).sum(1) / 2
        q = np.array([r.unit for r in rows]) @ self.coarse.T - half
        home = (np.array([r.v for r in rows]) @ self.coarse.T - half).argmax(1)
        place = (q > q[np.arange(len(q)), home][:, None]).sum(1)
        # few queries say less of others: what may be lost of their neighbours shrinks with their number
        target = 1 - (1 - target) * min(1.0, queries.count() / CALIBRATION_QUERIES)
        share = (1 + target) / 2  # half of what may be lost goes to each of the two limits
        self.nprobe = int(np.sort(place)[int(np.ceil(share * len(place))) - 1]) + 1
        found = self.candidates(queries, MAX_DEPTH).join(exact.select("query", "key"), ["query", "key"])
        ranks = sorted(r.place for r in found.select("place").collect())
        need = int(np.ceil(target * len(rows)))
        self.depth = max(k, ranks[min(need, len(ranks)) - 1] if ranks else MAX_DEPTH)

    def candidates(self, queries: DataFrame, depth: int) -> DataFrame:
        """(query, key, place): the first ``depth`` keys of every query by the quantised score."""
        qtype = queries.schema["query"].dataType.simpleString()
        ktype = self.units.schema["key"].dataType.simpleString()
        probes = queries.select("query", "unit").mapInArrow(
            _probe(self.coarse, self.nprobe), f"list int, queries array<{qtype}>, vecs binary")
        scored = (probes.join(self.blocks, "list").select("list", "queries", "vecs", "keys", "codes")
                  .mapInArrow(_score(self.coarse, self.books, depth),
                              f"query {qtype}, key {ktype}, approx double"))
        w = Window.partitionBy("query").orderBy(F.col("approx").desc(), "key")
        return (scored.filter(F.col("query") != F.col("key")).withColumn("place", F.row_number().over(w))
                .filter(F.col("place") <= depth).select("query", "key", "place"))

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query, key, score, rank): re-ranked top ``k`` by exact cosine; ``queries`` is (query, unit)."""
        queries = queries.filter(F.size("unit") == self.dim)
        best = (self.candidates(queries, max(k, self.depth))
                .join(self.units.select("key", F.col("unit").alias("v")), "key").join(queries, "query"))
        dot = F.aggregate(F.zip_with("unit", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return _ranked(best.select("query", "key", dot.alias("score")), k)


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.round("score", 9).desc(), "key")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _residuals(coarse: np.ndarray, dim: int):
    slices = -(-dim // SLICE)
    width = SLICE

    def run(frames):
        import numpy as np
        import pandas as pd
        half = (coarse ** 2).sum(1) / 2
        for pdf in frames:
            x = np.stack(pdf["unit"].to_numpy())
            r = np.pad(x - coarse[(x @ coarse.T - half).argmax(1)], ((0, 0), (0, slices * width - dim)))
            for p in range(slices):
                yield pd.DataFrame({"part": p, "x": list(r[:, p * width:(p + 1) * width])})
    return run, slices


def _encode(coarse: np.ndarray, books: np.ndarray):
    """Blocks (list, keys, codes) of a task's rows, at most ``BLOCK_ROWS`` of them at a time."""
    slices, _, width = books.shape
    dim, limit = coarse.shape[1], BLOCK_ROWS

    def run(batches):
        import numpy as np
        import pyarrow as pa
        half = (coarse ** 2).sum(1) / 2
        halves = (books ** 2).sum(2) / 2

        def block(keys, lists, codes):
            order = np.argsort(lists, kind="stable")
            lists, codes = lists[order], codes[order]
            starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
            ends = np.r_[starts[1:], len(lists)]
            held = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(lists)], pa.int32()),
                                            pa.concat_arrays(keys).take(pa.array(order)))
            return pa.RecordBatch.from_arrays(
                [pa.array(lists[starts], pa.int32()), held,
                 pa.array([codes[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                names=["list", "keys", "codes"])

        keys, lists, codes, n = [], [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            home = np.concatenate([(x[i:i + 2048] @ coarse.T - half).argmax(1) for i in range(0, len(x), 2048)])
            r = np.pad(x - coarse[home], ((0, 0), (0, slices * width - dim)))
            code = np.empty((len(x), slices), "u1")
            for p in range(slices):
                code[:, p] = (r[:, p * width:(p + 1) * width] @ books[p].T - halves[p]).argmax(1)
            keys.append(b.column("key"))
            lists.append(home)
            codes.append(code)
            n += len(x)
            if n >= limit:
                yield block(keys, np.concatenate(lists), np.concatenate(codes))
                keys, lists, codes, n = [], [], [], 0
        if n:
            yield block(keys, np.concatenate(lists), np.concatenate(codes))
    return run


def _probe(coarse: np.ndarray, nprobe: int):
    """Rows (list, queries, vecs): the queries of a batch that probe a list, ``QUERY_ROWS`` at most."""
    dim, limit = coarse.shape[1], QUERY_ROWS

    def run(batches):
        import numpy as np
        import pyarrow as pa
        half = (coarse ** 2).sum(1) / 2
        for whole in batches:
            for at in range(0, whole.num_rows, limit):
                b = whole.slice(at, limit)
                x = b.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                probed = np.argsort(-(x @ coarse.T - half), axis=1, kind="stable")[:, :nprobe]
                who = np.repeat(np.arange(len(x)), probed.shape[1])
                lists = probed.ravel()
                order = np.argsort(lists, kind="stable")
                who, lists = who[order], lists[order]
                starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
                ends = np.r_[starts[1:], len(lists)]
                held = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(lists)], pa.int32()),
                                                b.column("query").take(pa.array(who)))
                x4 = x.astype("f4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists[starts], pa.int32()), held,
                     pa.array([x4[who[s:e]].tobytes() for s, e in zip(starts, ends)], pa.binary())],
                    names=["list", "queries", "vecs"])
    return run


def _score(coarse: np.ndarray, books: np.ndarray, depth: int):
    """Queries of a list against its blocks: the best ``depth`` keys (and the query's own) per query.

    Candidates are cut to that many per query each time ``MERGE_ROWS`` have come together.
    """
    slices, _, width = books.shape
    dim, limit, most = coarse.shape[1], MERGE_ROWS, depth + 1

    def run(batches):
        import numpy as np
        import pyarrow as pa
        table = books.astype("f4")
        slot = np.arange(slices)

        def merged(held):
            queries, keys = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
            score = np.concatenate([h[2] for h in held])
            who = queries.dictionary_encode().indices.to_numpy()
            order = np.lexsort((-score, who))
            first = np.flatnonzero(np.r_[True, np.diff(who[order]) != 0])
            place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
            order = order[place < most]
            return pa.RecordBatch.from_arrays([queries.take(pa.array(order)), keys.take(pa.array(order)),
                                               pa.array(score[order])], names=["query", "key", "approx"])

        held, n = [], 0
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                keys, queries = row.column("keys").flatten(), row.column("queries").flatten()
                code = np.frombuffer(row.column("codes")[0].as_py(), "u1").reshape(-1, slices)
                near = table[slot, code].reshape(len(code), slices * width)[:, :dim]
                near = near + coarse[row.column("list")[0].as_py()].astype("f4")
                q = np.frombuffer(row.column("vecs")[0].as_py(), "f4").reshape(-1, dim)
                for at in range(0, len(q), 64):
                    s = q[at:at + 64] @ near.T
                    take = min(most, s.shape[1])
                    best = np.argpartition(-s, take - 1, axis=1)[:, :take]
                    who = np.repeat(np.arange(at, at + len(s)), take)
                    held.append((queries.take(pa.array(who)), keys.take(pa.array(best.ravel())),
                                 np.take_along_axis(s, best, 1).ravel().astype("f8")))
                    n += len(who)
                    if n >= limit:
                        yield merged(held)
                        held, n = [], 0
        if n:
            yield merged(held)
    return run


def exact_top(units: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, key, score, rank) by exact cosine against every row, for a bounded query set.

    ``queries`` (query, unit) is collected: callers hand over a stated, bounded
    sample.  Tasks keep ``k`` keys per query and batch, ties at the edge included.
    """
    rows = queries.select("query", "unit").orderBy("query").collect()
    schema = (f"query {queries.schema['query'].dataType.simpleString()}, "
              f"key {units.schema['key'].dataType.simpleString()}, score double")
    if not rows:
        return _ranked(units.sparkSession.createDataFrame([], schema), k)
    names, q = [r.query for r in rows], np.array([r.unit for r in rows])

    def run(frames):
        import numpy as np
        import pandas as pd
        for pdf in frames:
            if not len(pdf):
                continue
            keys = pdf["key"].to_numpy()
            s = np.stack(pdf["unit"].to_numpy()) @ q.T
            for j, name in enumerate(names):
                own = s[:, j].copy()
                own[keys == name] = -2.0
                edge = np.sort(own)[-k] if len(own) >= k else -1.5
                at = np.flatnonzero((own >= max(edge, -1.5) - 1e-9))
                at = at[np.lexsort((keys[at], -np.round(own[at], 9)))][:k]
                yield pd.DataFrame({"query": name, "key": keys[at], "score": own[at]})
    found = units.filter(F.size("unit") == q.shape[1]).select("key", "unit").mapInPandas(run, schema)
    return _ranked(found, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, exact neighbours and those that ``found`` equals or ties with, as ``recall``."""
    last = exact.groupBy("query").agg(F.min("score").alias("edge"), F.count(F.lit(1)).alias("n"))
    hits = (found.join(last, "query").filter(F.col("score") >= F.col("edge") - 1e-9)
            .groupBy("query").agg(F.count(F.lit(1)).alias("hit")))
    j = last.join(hits, "query", "left").withColumn("hit", F.least(F.coalesce("hit", F.lit(0)), "n"))
    return j.agg(F.count(F.lit(1)).alias("n_queries"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_neighbours"),
                 F.try_divide(F.sum("hit"), F.sum("n")).alias("recall"))
