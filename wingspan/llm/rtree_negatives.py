"""Hard negatives by best-first search over STR-packed R-trees of vectors.

For every anchor row the ``positives`` best other rows of its label are found,
then per (anchor, positive) the ``negatives`` best rows of other labels whose
score lies in a window set by the positive's score.

* Packing: rows are range-partitioned by their leading coordinates (those of
  most variance in a bounded sample), so a part holds near vectors; each part
  is cut into trees of at most ``tree_rows`` rows.  Inside a tree
  sort-tile-recursive packing orders the rows by slabs of one coordinate after
  the other; LEAF neighbours share a leaf box, FANOUT boxes their parent's box.
  Row ids end the range order, so copies of one vector spread over trees.
* Bounds: over a box every coordinate of the product lies in an interval; their
  sums bound the scores of an anchor below and above.
* Search: a queue takes the box of the highest bound first.  A box is dropped
  for a search whose score window its interval misses, or whose k-th score so
  far is strictly above its bound (an equal score may win by its id).
* Distribution: anchors travel in blocks of at most ``anchor_rows``.  A block
  meets a tree only if the interval of the two boxes reaches what the block
  still needs; the pairs (block, tree) are the tasks' groups, each of bounded
  size.  Top lists of the trees meet in a ranked window per search.

The result is exact; the sample decides only which coordinates pack the rows.
Scores are 64-bit integers.

Nulls and edges: rows with a null id, label or vector, an empty vector, or a
null or non-finite component take no part.  Shorter vectors are padded with
zeros.  Rows of one id count once (the largest by label, then vector, stands
for it).  An anchor without positives, or a positive without negatives, gives
no rows; empty tables give none.  Other columns take no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored
from wingspan.llm.voronoi_knn import _EXACT, _best, _matrix, integer_vectors

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE = 256
LEAF, FANOUT = 64, 8
TREE_ROWS = 8192
ANCHOR_ROWS = 1024
SAMPLE = 10_000
SPLIT_DIMS = 3
_LOWEST = np.iinfo(np.int64).min + 1
_LAST = np.iinfo(np.int64).max


def labelled(df: DataFrame, id_col: str, label: str | Column, vec_col: str, scale: int) -> DataFrame:
    """(id, label, v): the rows that take part, one per id."""
    lab = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.col(id_col).alias("id"), lab.alias("label"), F.col(vec_col).alias("vec")).filter(
        F.col("label").isNotNull())
    v = integer_vectors(rows.select(F.struct("id", "label").alias("key"), "vec"), "key", "vec", scale)
    v = v.select("id.id", "id.label", "v").filter(F.col("id").isNotNull())
    # ids alone are shuffled unless some repeat
    twice = stored(v.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "rtree-repeats")
    merged = v.join(twice, "id", "left_semi").groupBy("id").agg(F.max(F.struct("label", "v")).alias("x"))
    return v.join(twice, "id", "left_anti").unionByName(merged.select("id", "x.label", "x.v"))


def str_order(x: np.ndarray, dims: list[int], leaf: int = LEAF) -> np.ndarray:
    """Row order by sort-tile-recursive packing over ``dims``."""
    def pack(rows: np.ndarray, left: list[int]) -> list[np.ndarray]:
        rows = rows[np.argsort(x[rows, left[0]], kind="stable")]
        if len(left) == 1:
            return [rows]
        slabs = max(1, round((len(rows) / leaf) ** (1 / len(left))))
        return [r for part in np.array_split(rows, slabs) for r in pack(part, left[1:])]
    return np.concatenate(pack(np.arange(len(x)), dims)) if len(x) else np.arange(0)


def tree_levels(x: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> list[tuple[np.ndarray, np.ndarray]]:
    """(low, high) corners of the boxes of every level, leaves first, up to one root."""
    at = np.arange(0, len(x), leaf)
    levels = [(np.minimum.reduceat(x, at), np.maximum.reduceat(x, at))]
    while len(levels[-1][0]) > 1:
        at = np.arange(0, len(levels[-1][0]), fanout)
        levels.append((np.minimum.reduceat(levels[-1][0], at), np.maximum.reduceat(levels[-1][1], at)))
    return levels


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of q with any point of each box."""
    pos, neg = np.maximum(q, 0), np.minimum(q, 0)
    return pos @ low.T + neg @ high.T, pos @ high.T + neg @ low.T


def search(q: np.ndarray, of: np.ndarray, qid: np.ndarray, qlabel: np.ndarray, low: np.ndarray, high: np.ndarray,
           same: bool, top: int, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF,
           fanout: int = FANOUT) -> tuple[np.ndarray, np.ndarray, int]:
    """Top lists of searches over one packed tree: (scores, ids, leaves read).

    Search j belongs to anchor ``of[j]``: rows of the anchor's label (``same``)
    or of other labels, not the anchor itself, with low[j] <= score <= high[j].
    """
    scores = np.full((len(of), top), _LOWEST)
    found = np.full((len(of), top), _LAST)
    levels = tree_levels(x, leaf, fanout)
    bounds = [intervals(q, *box) for box in levels]
    exact = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < _EXACT
    # bounds are exact while the products are; beyond that a small relative slack covers rounding
    slack = 0.0 if exact else 1e-9 * (1 + max(np.abs(b).max(initial=0) for pair in bounds for b in pair))
    heap = [(-np.inf, len(levels) - 1, 0)]
    read = 0
    while heap:
        _, level, node = heapq.heappop(heap)
        least, most = bounds[level][0][of, node] - slack, bounds[level][1][of, node] + slack
        live = np.flatnonzero((least <= high) & (most >= low) & (most >= scores[:, -1]))
        if not len(live):
            continue
        if level:
            kids = range(node * fanout, min((node + 1) * fanout, len(levels[level - 1][0])))
            best = bounds[level - 1][1][np.unique(of[live])][:, kids].max(0)
            for kid, b in zip(kids, best):
                heapq.heappush(heap, (-b, level - 1, kid))
            continue
        read += 1
        rows = slice(node * leaf, (node + 1) * leaf)
        who, at = np.unique(of[live], return_inverse=True)
        if exact:
            s = (q[who] @ x[rows].T).astype(np.int64)
        else:
            s = q[who].astype(np.int64) @ x[rows].T.astype(np.int64)
        fits = (labels[rows] == qlabel[who][:, None]) == same
        s = np.where(fits & (ids[rows] != qid[who][:, None]), s, _LOWEST)[at]
        s = np.where((s >= low[live][:, None]) & (s <= high[live][:, None]), s, _LOWEST)
        gain = np.flatnonzero(((s > _LOWEST) & (s >= scores[live][:, -1:])).any(1))
        if len(gain):
            at, s = live[gain], s[gain]
            scores[at], found[at] = _best(np.concatenate([scores[at], s], 1), np.concatenate(
                [found[at], np.broadcast_to(ids[rows], s.shape)], 1), top)
    return scores, found, read


def _packed(dim: int, dims: list[int], size: int, build: bool):
    """mapInArrow function from (id, label, v) rows to one row per part of at most ``size`` rows."""
    def emit(ids, labels, x):
        order = str_order(x, dims) if build else np.arange(len(x))
        ids, labels, x = ids[order], labels[order], x[order]
        return [f"{ids[0]}", len(ids), x.min(0).tolist(), x.max(0).tolist(), ids.tobytes(), labels.tobytes(), x.tobytes()]

    def run(batches):
        rows: list[list] = []
        held: list[tuple] = []
        n = 0
        for b in batches:
            got = (b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy().astype(np.int64),
                   _matrix(b.column(2), dim))
            for at in range(0, len(got[0]), size):
                held.append(tuple(z[at:at + size] for z in got))
                n += len(held[-1][0])
                while n >= size:
                    whole = [np.concatenate(z) for z in zip(*held)]
                    rows.append(emit(*(z[:size] for z in whole)))
                    held, n = [tuple(z[size:] for z in whole)], n - size
            for r in rows:
                yield _as_batch([r])
            rows = []
        if n:
            yield _as_batch([emit(*(np.concatenate(z) for z in zip(*held)))])
    return run


_PART = "part string, n long, low array<double>, high array<double>, ids binary, labels binary, m binary"


def _as_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      [f.split()[0] for f in _PART.split(", ")])


def _reach(sign: int) -> Column:
    """Bound of the inner products between the boxes (alow, ahigh) and (low, high): least (-1) or greatest (1)."""
    a = F.arrays_zip("alow", "ahigh", "low", "high")
    pick = F.greatest if sign > 0 else F.least
    return F.aggregate(a, F.lit(0.0), lambda s, z: s + pick(
        z.alow * z.low, z.alow * z.high, z.ahigh * z.low, z.ahigh * z.high))


def _searched(asked: DataFrame, trees: DataFrame, dim: int, same: bool, top: int) -> DataFrame:
    """(anchor, key, id, score) best rows of every search over all trees.

    ``asked``: one row per block of anchors: part, alow, ahigh (box), least
    and most (range of all score windows), ids, labels, m, and the searches
    of the block as of, key, lo, hi (little-endian 64-bit arrays).
    """
    pairs = (asked.select(F.col("part").alias("block"), "alow", "ahigh", "least", "most")
             .join(trees.select(F.col("part").alias("tree"), "low", "high"),
                   (_reach(1) * (1 + 1e-9) + 1 >= F.col("least").cast("double"))
                   & (_reach(-1) * (1 - 1e-9) - 1 <= F.col("most").cast("double")))
             .select("block", "tree"))
    left = pairs.join(asked.select(F.col("part").alias("block"), "ids", "labels", "m", "of", "key", "lo", "hi"), "block")
    right = pairs.toDF("to", "at").join(trees.select(F.col("part").alias("at"), "ids", "labels", "m"), "at")

    def local(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for a in left.to_pylist():
            n = len(a["ids"]) // 8
            q = np.frombuffer(a["m"]).reshape(n, dim)
            qid, qlabel, of, key, lo, hi = (np.frombuffer(a[c], np.int64) for c in
                                            ("ids", "labels", "of", "key", "lo", "hi"))
            for t in right.to_pylist():
                ids, labels = np.frombuffer(t["ids"], np.int64), np.frombuffer(t["labels"], np.int64)
                s, f, _ = search(q, of, qid, qlabel, lo, hi, same, top,
                                 np.frombuffer(t["m"]).reshape(-1, dim), ids, labels)
                real = s > _LOWEST
                out.append((np.repeat(qid[of], real.sum(1)), np.repeat(key, real.sum(1)), f[real], s[real]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c) for c in cols], names=["anchor", "key", "id", "score"])

    partial = (left.groupBy("block", "tree").cogroup(right.groupBy("to", "at"))
               .applyInArrow(local, "anchor long, key long, id long, score long"))
    rank = F.row_number().over(Window.partitionBy("anchor", "key").orderBy(F.col("score").desc(), F.col("id")))
    return partial.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top)


_ASKED = ("part string, alow array<double>, ahigh array<double>, least long, most long, ids binary, labels binary, "
          "m binary, of binary, key binary, lo binary, hi binary")


def _with_searches(blocks: DataFrame, searches: DataFrame | None) -> DataFrame:
    """Blocks of anchors with their searches; without ``searches`` (part, id, key, lo, hi) one open one per anchor."""
    names = [c.split()[0] for c in _ASKED.split(", ")]

    def open_row(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for r in b.to_pylist():
            n = len(r["ids"]) // 8
            rows.append((r["part"], r["low"], r["high"], _LOWEST + 1, _LAST, r["ids"], r["labels"], r["m"],
                         np.arange(n).tobytes(), np.zeros(n, np.int64).tobytes(),
                         np.full(n, _LOWEST + 1).tobytes(), np.full(n, _LAST).tobytes()))
        return _asked_batch(rows, names)

    if searches is None:
        return blocks.mapInArrow(lambda it: (open_row(b) for b in it if len(b)), _ASKED)

    def closed(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for r in left.to_pylist():
            ids = np.frombuffer(r["ids"], np.int64)
            sid, key, lo, hi = (right[c].to_numpy().astype(np.int64) for c in ("id", "key", "lo", "hi"))
            if not len(sid):
                continue
            order = np.argsort(ids)
            of = order[np.searchsorted(ids, sid, sorter=order)]
            rows.append((r["part"], r["low"], r["high"], int(lo.min()), int(hi.max()), r["ids"], r["labels"], r["m"],
                         *(z.astype(np.int64).tobytes() for z in (of, key, lo, hi))))
        return pa.Table.from_batches([_asked_batch(rows, names)])

    return blocks.groupBy("part").cogroup(searches.groupBy("part")).applyInArrow(closed, _ASKED)


def _asked_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.list_(pa.float64())] * 2, *[pa.int64()] * 2, *[pa.binary()] * 7]
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label: str | Column = "label",
                   vec_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE, tree_rows: int = TREE_ROWS,
                   anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition over the column ``id``; ``label`` a column of
    ``df`` (an integer) or an expression.  A negative's score s and the
    positive's p satisfy low * p <= 100 * s <= high * p.
    """
    spark = df.sparkSession
    out_schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                  "negative_score long")
    rows = stored(labelled(df, id_col, label, vec_col, scale), "rtree-rows")
    shape = rows.agg(F.max(F.size("v")).alias("dim"), F.count("*").alias("n")).first()
    if not shape.n:
        return spark.createDataFrame([], out_schema)
    dim = shape.dim
    # a bounded sample (SAMPLE rows) picks the coordinates that pack the rows; any choice gives the same result
    sample = rows.orderBy(F.xxhash64("id"), "id").select("v").limit(SAMPLE).agg(*[
        F.coalesce(F.var_pop(F.coalesce(F.get("v", F.lit(i)), F.lit(0.0))), F.lit(0.0)).alias(f"d{i}")
        for i in range(dim)]).first()
    dims = sorted(range(dim), key=lambda i: -sample[i])[:SPLIT_DIMS]
    parts = max(1, -(-shape.n // tree_rows))
    near = rows.repartitionByRange(parts, *[F.coalesce(F.get("v", F.lit(i)), F.lit(0.0)) for i in dims[:1]], "id")
    trees = stored(near.mapInArrow(_packed(dim, dims, tree_rows, True), _PART), "rtree-trees")
    blocks = stored(rows.filter(is_anchor).mapInArrow(_packed(dim, dims, anchor_rows, False), _PART), "rtree-anchors")

    best = _searched(_with_searches(blocks, None), trees, dim, True, positives)
    best = stored(best.select("anchor", F.col("id").alias("positive"), F.col("score").alias("ps")), "rtree-positives")
    bound = [F.col("ps").cast("decimal(38,0)") * c for c in (low, high)]
    window = best.select("anchor", "positive", F.ceil(bound[0] / 100).alias("lo"), F.floor(bound[1] / 100).alias("hi"))
    member = blocks.mapInArrow(_members, "part string, id long")
    searches = (window.filter("lo <= hi").join(member, F.col("anchor") == F.col("id"))
                .select("part", "id", F.col("positive").alias("key"), F.col("lo").cast("long").alias("lo"),
                        F.col("hi").cast("long").alias("hi")))
    asked = stored(_with_searches(blocks, searches), "rtree-searches")
    got = _searched(asked, trees, dim, False, negatives)
    return (got.join(best, (got.anchor == best.anchor) & (got.key == best.positive))
            .select(got.anchor.alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                    F.col("id").alias("negative_id"), F.col("ps").alias("positive_score"),
                    F.col("score").alias("negative_score")))


def _members(batches):
    """(part, id) of every row of blocks."""
    for b in batches:
        for part, ids in zip(b["part"].to_pylist(), b["ids"].to_pylist()):
            ids = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.string()), pa.array(ids)], ["part", "id"])
